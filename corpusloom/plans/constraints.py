"""Constraints of a table as one pass over the rows to be loaded: rows that break any go to quarantine, with the names of what they break."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A condition in SQL that rows must not fail; as in SQL, one that is null isn't failed."""

    name: str
    condition: str


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str


@dataclass(frozen=True)
class Unique:
    """Keys that no two rows may share, among the rows that meet `where`. A row with a null among its keys shares them with none. The first row in order keeps its place."""

    name: str
    keys: tuple[str, ...]
    where: str = "true"


Constraint = Check | NotNull | Unique

#: The constraints of the registry of papers.
PAPERS: tuple[Constraint, ...] = (
    *(NotNull(f"{c}_given", c) for c in ("paper_uid", "identifier_type", "identifier_value", "sources", "source_count", "source_order", "canonical_source", "download_status", "attempt_count")),
    Check("identifier_type_known", "identifier_type IN ('doi', 'arxiv_id')"),
    Check("download_status_known", "download_status IN ('pending', 'success', 'failed', 'exhausted')"),
    Check("identifier_present", "(identifier_type = 'doi' AND doi IS NOT NULL) OR (identifier_type = 'arxiv_id' AND arxiv_id IS NOT NULL)"),
    Unique("paper_uid_unique", ("paper_uid",)),
    Unique("identifier_unique", ("identifier_type", "identifier_value")),
    Unique("doi_unique", ("doi",)),
    Unique("arxiv_id_unique", ("arxiv_id",), "identifier_type = 'arxiv_id'"),
)


def _broken(c: Constraint, order: Sequence[str]) -> Column:
    if isinstance(c, NotNull):
        return F.col(c.column).isNull()
    if isinstance(c, Check):
        return F.coalesce(~F.expr(c.condition), F.lit(False))
    counts = F.coalesce(F.expr(c.where), F.lit(False)) & reduce(and_, (F.col(k).isNotNull() for k in c.keys))
    spread = F.when(~counts, F.xxhash64(*order))  # rows that the rule leaves out are no group
    return counts & (F.row_number().over(Window.partitionBy(counts, spread, *(F.when(counts, F.col(k)) for k in c.keys)).orderBy(*order)) > 1)


def judged(df: DataFrame, constraints: Sequence[Constraint], order: Sequence[str]) -> DataFrame:
    """Every row with `broken`, the names of the constraints that it breaks, in their order. `order` decides which of several rows with one key came first."""
    named = F.array(*(F.when(_broken(c, order), F.lit(c.name)) for c in constraints))
    return df.withColumn("broken", F.array_compact(named))


def violations(df: DataFrame, constraints: Sequence[Constraint], order: Sequence[str]) -> DataFrame:
    """rule, rows: how many rows break each constraint, 0 included."""
    one = judged(df, constraints, order).agg(*(F.count_if(F.array_contains("broken", c.name)).alias(c.name) for c in constraints))
    return one.unpivot([], [c.name for c in constraints], "rule", "rows")


def load(df: DataFrame, constraints: Sequence[Constraint], order: Sequence[str], path: str, mode: str = "errorifexists") -> dict[str, int]:
    """Write good rows to `path`/valid=true and the others, with `broken`, to `path`/valid=false, in one job; how many were good, and how many broke each rule."""
    seen = Observation()
    counts = [F.count_if(F.array_contains("broken", c.name)).alias(c.name) for c in constraints]
    rows = judged(df, constraints, order).observe(seen, F.count_if(F.size("broken") == 0).alias("good"), *counts)
    rows.withColumn("valid", F.size("broken") == 0).write.mode(mode).partitionBy("valid").parquet(path)
    return dict(seen.get)


def loaded(spark: SparkSession, path: str, valid: bool = True) -> DataFrame:
    """The good rows of a load, or its quarantine with what each row broke."""
    rows = spark.read.parquet(path).where(F.col("valid") == valid).drop("valid")
    return rows.drop("broken") if valid else rows
