"""Changes to tables as new tables: every function returns the frame to be written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import is_missing
from .dedup import keep_first


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """`old` and the first of each new key that it lacks; new rows without a key are skipped."""
    fresh = keep_first(new.dropna(subset=list(keys)), keys, *order).join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(fresh)


def insert_counts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of what insert_ignore() does: rows inserted, rows whose key was there or came before, rows without a key."""
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    groups = new.groupBy(*keys).agg(F.count("*").alias("_n")).join(old.select(*keys).distinct().withColumn("_old", F.lit(1)), list(keys), "left")
    fresh = keyed & F.col("_old").isNull()
    some = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).cast("bigint")
    return groups.agg(F.count_if(fresh).alias("inserted"), (some(keyed) - F.count_if(fresh)).alias("ignored"), some(~keyed).alias("skipped"))


def rebuilt(df: DataFrame, path: str, change: Callable[[DataFrame], DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """A changed copy of a table under a new path, if it has as many rows and its keys are unique; else the copy stays aside and an error is raised."""
    change(df).write.mode("errorifexists").parquet(path)
    new = df.sparkSession.read.parquet(path)
    if (before := df.count()) != (after := new.count()):
        raise ValueError(f"{before} rows became {after}")
    return unique_or_raise(new, keys) if keys else new


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """New rows replace old ones of their key; of several the one with the greatest `sequence`."""
    latest = keep_first(new, keys, -F.col(sequence))
    return old.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest)


def replace(old: DataFrame, new: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """INSERT OR REPLACE: the last writer wins."""
    return upsert(old, new, keys, sequence)


def fill_missing(df: DataFrame, column: str, value: Column) -> Column:
    """`column`, or `value` where it is missing (blank of any script counts as missing)."""
    return F.when(is_missing(F.col(column)) & ~is_missing(value), value).otherwise(F.col(column)).alias(column)


def update_from(df: DataFrame, mapping: DataFrame, key: str, target: str, where: Column | None = None) -> DataFrame:
    """`target` set from mapping(key, value) where the row meets `where`; other rows stay."""
    named = mapping.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    allowed = F.lit(True) if where is None else where
    return df.join(named, F.col(key) == F.col("_key"), "left").withColumn(target, F.when(allowed & F.col("_key").isNotNull(), F.col("_value")).otherwise(F.col(target))).drop("_key", "_value")


def delete_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def cleaned_copy(df: DataFrame, columns: Sequence[str], needed: Sequence[str], path: str, overwrite: bool = False) -> dict[str, int]:
    """Write `columns` of the rows that have all `needed`, and how many were accepted and rejected: one pass, which counts what it writes."""
    if absent := [c for c in (*columns, *needed) if c not in df.columns]:
        raise ValueError(f"no such columns: {absent}")
    whole = F.lit(True)
    for c in needed:
        whole = whole & ~is_missing(F.col(c))
    seen = Observation()
    counted = df.withColumn("_whole", whole).observe(seen, F.count("*").alias("total"), F.count_if("_whole").alias("accepted"))
    counted.where("_whole").select(*columns).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    total, kept = seen.get["total"], seen.get["accepted"]
    return {"total": total, "accepted": kept, "rejected": total - kept}


def unique_or_raise(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, if its keys are unique; a load into a table with a primary key would fail otherwise."""
    if not df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"duplicate keys in {list(keys)}")
    return df


def schema_synced(df: DataFrame, wanted: StructType) -> DataFrame:
    """`df` with the columns of `wanted` that it lacks, as nulls; a column of another type is an error."""
    have = {f.name: f.dataType for f in df.schema}
    if wrong := [f.name for f in wanted if f.name in have and have[f.name] != f.dataType]:
        raise TypeError(f"other types: {wrong}")
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in wanted if f.name not in have})


def clustered_write(df: DataFrame, path: str, key: str, parts: int, mode: str = "errorifexists") -> None:
    """Write in the order of a key, so that scans prune row groups by it."""
    df.repartitionByRange(parts, key).sortWithinPartitions(key).write.mode(mode).parquet(path)
