"""Row filters of the corpus: required fields, keywords, exclusions, queue states."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ci, is_filled_sql, is_missing

#: Statuses that a search leaves behind where it settled the matter.
SETTLED = ("scopus_search", "scopus_no_abstract", "scopus_not_found", "scopus_error")


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Some columns, which all have to be there."""
    if absent := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {absent}")
    return df.select(*columns)


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.where(is_filled_sql(F.col(c)))
    return df


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, missing) per column, and `any` for rows that lack one of them: one pass."""
    gone = [~is_filled_sql(F.col(c)) for c in columns]
    one = df.agg(*(F.count_if(g).alias(c) for c, g in zip(columns, gone, strict=True)), F.count_if(reduce(or_, gone)).alias("any"))
    return one.unpivot([], [*columns, "any"], "field", "missing")


def keyword(df: DataFrame, word: str, *columns: str) -> DataFrame:
    """Rows with the word in one of the columns, without regard to case."""
    return df.where(reduce(or_, (contains_ci(F.col(c), word) for c in columns)))


def keyword_in_filled(df: DataFrame, word: str, column: str) -> DataFrame:
    """Rows whose column says something and holds the word, without regard to case."""
    return keyword(df.where(is_filled_sql(F.col(column))), word, column)


def without_pattern(df: DataFrame, pattern: str, *columns: str) -> DataFrame:
    """Rows without the pattern (no regard to case) in any of the columns; null holds no pattern."""
    return df.where(~reduce(or_, (F.coalesce(F.col(c).rlike(f"(?i){pattern}"), F.lit(False)) for c in columns)))


def excluding(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Rows whose key isn't in `listed`, a one-column frame; Spark broadcasts it if its size allows."""
    name = listed.columns[0]
    return df.join(listed.select(F.col(name).alias("_listed")).distinct(), F.col(key) == F.col("_listed"), "left_anti")


def excluding_values(df: DataFrame, key: str, values: Iterable) -> DataFrame:
    """As excluding(), for a short list of a configuration file; null keys stay."""
    return df.where(~F.coalesce(F.col(key).isin(list(values)), F.lit(False)))


def lacks_abstract(abstract: Column, key: Column, source: Column) -> Column:
    """No abstract, a key to search by, and no search that settled it; null-safe."""
    return abstract.isNull() & ~is_missing(key) & (source.isNull() | ~source.isin(*SETTLED))


def unprocessed(df: DataFrame, key: str, done: str, order: str, limit: int | None = None) -> DataFrame:
    """Rows with a key that aren't marked done, in order."""
    rows = df.where(is_filled_sql(F.col(key)) & (F.coalesce(F.col(done), F.lit(0)) == 0)).orderBy(order)
    return rows if limit is None else rows.limit(limit)


def pending(df: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """The download queue of a source."""
    rows = df.where((F.col("canonical_source") == source) & (F.col("download_status") == "pending")).orderBy("paper_uid")
    return rows if limit is None else rows.limit(limit)


def inconsistent_order(df: DataFrame) -> DataFrame:
    """Rows whose source_order doesn't begin with their canonical source (no LIKE: an underscore is no wildcard)."""
    return df.where(~F.col("source_order").startswith(F.concat(F.lit('["'), F.col("canonical_source"), F.lit('"'))))
