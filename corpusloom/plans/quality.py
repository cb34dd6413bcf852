"""Checks of the registry: each is a number of issues, which should be none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.convert import has_history


def duplicate_groups(df: DataFrame, *keys: str) -> DataFrame:
    """How many non-null keys occur more than once."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("issue_count"))


def checks(papers: DataFrame) -> DataFrame:
    """(check, issue_count, passed): row checks share one pass, duplicate checks have one each."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    listed = F.from_json("sources", "array<string>")
    rows = {
        "missing_identifier": blank("identifier_value") | F.col("identifier_type").isNull(),
        "inconsistent_identifier": ((F.col("identifier_type") == "doi") & ~F.col("doi").eqNullSafe(F.col("identifier_value"))) | ((F.col("identifier_type") == "arxiv_id") & ~F.col("arxiv_id").eqNullSafe(F.col("identifier_value"))),
        "missing_canonical_source": blank("canonical_source"),
        "wrong_source_count": F.size(listed) != F.col("source_count"),
        "wrong_initial_status": (F.col("download_status") != "pending") | (F.col("attempt_count") != 0),
        "order_not_canonical": ~F.col("source_order").startswith(F.concat(F.lit('["'), F.col("canonical_source"), F.lit('"'))),
    }
    one = papers.agg(*(F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in rows.items())).unpivot([], list(rows), "check", "issue_count")
    for name, keys in (("duplicate_uid", ["paper_uid"]), ("duplicate_identifier", ["identifier_type", "identifier_value"]), ("duplicate_doi", ["doi"])):
        one = one.unionByName(duplicate_groups(papers, *keys).select(F.lit(name).alias("check"), "issue_count"))
    return one.select("check", F.col("issue_count").cast("bigint").alias("issue_count"), (F.col("issue_count") == 0).alias("passed"))


def success_audit(papers: DataFrame) -> DataFrame:
    """(metric, count) of downloaded papers that lack what success implies."""
    done = papers.where("download_status = 'success'")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    metrics = {"success_rows": F.lit(True), "missing_path": blank("fulltext_path"), "missing_format": blank("fulltext_format"), "with_last_error": ~blank("last_error"), "with_history": has_history(F.col("failure_history"))}
    return done.agg(*(F.count_if(c).alias(n) for n, c in metrics.items())).unpivot([], list(metrics), "metric", "count")


def contract(df: DataFrame, needed: Sequence[str]) -> list[str]:
    """Needed columns that a source lacks."""
    return [c for c in needed if c not in df.columns]


def schema_report(frames: dict[str, DataFrame]) -> list[tuple[str, str, str, bool]]:
    """(source, column, type, nullable) of each source."""
    return [(s, f.name, f.dataType.simpleString(), f.nullable) for s, df in frames.items() for f in df.schema]
