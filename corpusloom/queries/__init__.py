"""Named queries over the driver's tables, each with its SQL where SQL can say it."""

from . import corpus, records, tables

QUERIES = corpus.QUERIES | records.QUERIES | tables.QUERIES
ORACLES = corpus.ORACLES | records.ORACLES | tables.ORACLES
