"""Deduplication and top-n by key: the order that decides is always said, and has a tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key. One row is carried per key and task before the shuffle, so a key of any size is no burden."""
    names = df.columns
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))).alias("_row"))
    return best.select("_row.*")


def keep_last_keyed(df: DataFrame, key: str, newest: str, tie: str) -> DataFrame:
    """Of rows with a key the newest (then the greatest tie), and all rows without a key."""
    names = df.columns
    some = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), F.struct(F.col(newest).isNotNull().alias("a"), F.col(newest).alias("b"), F.col(tie).alias("c"))).alias("_row")).select("_row.*")
    return some.unionByName(df.where(F.col(key).isNull()))


def top_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key; Spark limits each task's groups before the shuffle."""
    return ranked(df, keys, *order).where(F.col("_rank") <= n).drop("_rank")


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int, id: str) -> DataFrame:
    """n rows of each key in the order of a seeded hash of `id`: the same rows on any partitioning."""
    return top_n(df, keys, n, F.xxhash64(F.lit(seed), F.col(id)), F.col(id))


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(k)


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null key occurs more than once."""
    many = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    return df.join(many, key, "left_semi")
