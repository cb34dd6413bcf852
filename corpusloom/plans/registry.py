"""The central registry: staging records of all sources merged to one row per identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import paper_uid
from ..operators.numbering import numbered

#: Rank of each source, best first.
PRIORITY = {"springer_nature": 1, "wiley": 2, "elsevier": 3, "europepmc": 4, "s2orc": 5, "arxiv": 6}
STAGING = ("staging_id", "source", "source_priority", "doi", "arxiv_id", "identifier_type", "identifier_value", "identifier_key", "title", "abstract")


def staged(papers: DataFrame) -> DataFrame:
    """Staging records of papers(staging_id, source, source_priority, doi, arxiv_id, title, abstract): the DOI identifies, else the arXiv
    id; rows with neither are dropped."""
    kind = F.when(F.col("doi").isNotNull(), "doi").when(F.col("arxiv_id").isNotNull(), "arxiv_id")
    value = F.coalesce("doi", "arxiv_id")
    out = papers.withColumns({"identifier_type": kind, "identifier_value": value, "identifier_key": F.concat_ws(":", kind, value)})
    return out.where(F.col("identifier_type").isNotNull()).select(*STAGING)


def priorities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PRIORITY.items()), "source string, source_priority int")


def assembled(staging: DataFrame) -> DataFrame:
    """One row per identifier_key: what a join of canonical, title, abstract and source lists would give, in two aggregations.

    Both group by identifier_key first, so one shuffle serves them; both combine in the tasks before it.
    """
    per_source = staging.groupBy("identifier_key", "source", "source_priority").agg(*(F.min_by(c, "staging_id").alias(c) for c in ("identifier_type", "identifier_value", "doi", "arxiv_id", "title", "abstract")))
    rank = F.struct("source_priority", "source")
    best = lambda c: F.min_by(c, F.struct((F.coalesce(F.trim(c), F.lit("")) == "").alias("blank"), F.col("source_priority"), F.col("source"))).alias(c)
    listed = F.to_json(F.transform(F.array_sort(F.collect_list(rank)), lambda s: s["source"]))
    return per_source.groupBy("identifier_key").agg(
        F.min("identifier_type").alias("identifier_type"), F.min("identifier_value").alias("identifier_value"), F.max("doi").alias("doi"), F.max("arxiv_id").alias("arxiv_id"),
        best("title"), best("abstract"), listed.alias("sources"), F.count("*").alias("source_count"), F.min_by("source", rank).alias("canonical_source"),
    )


def merged(staging: DataFrame) -> DataFrame:
    """The registry: DOI rows before arXiv rows, each in the order of its value, numbered from 1; all waiting to be downloaded."""
    rows = numbered(assembled(staging), "paper_id", F.when(F.col("identifier_type") == "doi", 0).otherwise(1), F.col("identifier_value"))
    return rows.select(
        "paper_id", paper_uid(F.col("paper_id")).alias("paper_uid"), "identifier_type", "identifier_value", "doi", "arxiv_id", "title", "abstract", "sources", "source_count", F.col("sources").alias("source_order"), "canonical_source",
        F.lit(1).alias("canonical_source_position"), F.lit("pending").alias("download_status"), F.lit(0).alias("attempt_count"), F.lit("[]").alias("attempted_sources"), F.lit("[]").alias("failure_history"),
    )
