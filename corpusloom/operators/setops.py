"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(frames: dict[str, DataFrame]) -> DataFrame:
    """All rows with the name of their frame as `source`; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("source", F.lit(n)) for n, df in frames.items()))


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that b lacks; nulls are equal."""
    return a.subtract(b)


def split_union(df: DataFrame, condition: Column, change) -> DataFrame:
    """`change` applied to the rows that meet the condition, joined by the others."""
    yes = F.coalesce(condition, F.lit(False))
    return change(df.where(yes)).unionByName(df.where(~yes))


def batched(df: DataFrame, size: int, *order: Column) -> DataFrame:
    """`batch` numbers of `size` rows in order, from 0."""
    from .numbering import numbered

    return numbered(df, "_number", *order).withColumn("batch", F.floor((F.col("_number") - 1) / size)).drop("_number")
