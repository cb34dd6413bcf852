"""Queries of this subpackage and their SQL, for `__spark_entry__`."""

from __future__ import annotations

from . import filter_audit, link_graph, warc
from .bpe_pairs import op5_bpe_pairs
from .compression_bands import op1_compression_bands
from .ego_join import op7_ego_join
from .packing_dp import op10_packing_dp
from .periodic_runs import op11_periodic_runs
from .phrase_automata import op3_phrase_automata
from .pii_infotheoretic import op8_pii_infotheoretic
from .simhash_covering import op6_simhash_covering
from .suffix_radix import op9_suffix_radix
from .toxicity_mil import op2_toxicity_mil

QUERIES = {f.__name__: f for f in (op1_compression_bands, op2_toxicity_mil, op3_phrase_automata, warc.op4_warc, op5_bpe_pairs, op6_simhash_covering, op7_ego_join, op8_pii_infotheoretic, op9_suffix_radix, op10_packing_dp, op11_periodic_runs, filter_audit.op12_filter_audit, link_graph.op13_link_graph)}
ORACLES: dict[str, str] = {"op4_warc": warc.ORACLE, "op12_filter_audit": filter_audit.ORACLE, "op13_link_graph": link_graph.ORACLE}
