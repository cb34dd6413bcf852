"""Keyed tables that lie in buckets by a hash of their key. A change reads and rewrites the buckets that it touches; the files of all others stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import listed, removed
from . import dml

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketTable:
    """Where a table lies, its key, into how many buckets it is dealt, and its columns. One writer at a time; readers of a table that is
    changed meanwhile need a published version (`plans.publish`)."""

    path: str
    keys: tuple[str, ...]
    buckets: int
    schema: StructType

    def number(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets).cast("long")).cast("int")

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """The table, or its buckets with these numbers: other folders aren't listed."""
        rows = spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, "integer")).parquet(self.path)
        return (rows if only is None else rows.where(F.col(BUCKET).isin([*only]))).drop(BUCKET)

    def write(self, df: DataFrame, mode: str) -> None:
        """A task writes a bucket, sorted by key. With mode `overwrite` only the buckets that `df` has are replaced."""
        dealt = df.select(*self.schema.names).withColumn(BUCKET, self.number())
        dealt.repartitionById(self.buckets, BUCKET).sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic").mode(mode).parquet(self.path)


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> BucketTable:
    """A new table at `path`, which mustn't exist. An empty one has no buckets yet."""
    table = BucketTable(path, tuple(keys), buckets, df.schema)
    table.write(df, "errorifexists")
    return table


def change(table: BucketTable, rows: DataFrame, made: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets that the keys of `rows` fall into by made(their old rows, `rows`), and give their numbers.

    Rows of `made` have to keep the keys of old or new rows. Numbers of buckets and names of their files go to the driver, and nothing else. A task that is lost is repeated; a change that was
    broken off can be made again, as every change of this module leaves the same table when it is repeated.
    """
    spark = rows.sparkSession
    touched = sorted(r[0] for r in rows.select(table.number().alias(BUCKET)).distinct().collect())
    if not touched:
        return []
    folders = [f"{table.path}/{BUCKET}={number}" for number in touched]
    before = [listed(spark, f) for f in folders]
    table.write(made(table.read(spark, touched), rows), "overwrite")
    for folder, files in zip(folders, before, strict=True):
        if files and files == listed(spark, folder):  # every write names its files anew: nothing was written here, so no row is left
            removed(spark, folder)
    return touched


def insert_ignore(table: BucketTable, new: DataFrame, *order: Column) -> list[int]:
    """INSERT OR IGNORE: the first row of each new key is added; rows without a key are skipped."""
    return change(table, new.dropna(subset=[*table.keys]), lambda old, some: dml.insert_ignore(old, some.select(*old.columns), table.keys, *order))


def upsert(table: BucketTable, new: DataFrame, sequence: str) -> list[int]:
    """ON CONFLICT DO UPDATE: of several new rows of a key the one with the greatest `sequence` replaces the old one. `sequence` may be a column of the table or not."""

    def merged(old: DataFrame, some: DataFrame) -> DataFrame:
        latest = dml.keep_first(some, table.keys, -F.col(sequence)).select(*old.columns)
        return old.join(latest.select(*table.keys), [*table.keys], "left_anti").unionByName(latest)

    return change(table, new.dropna(subset=[*table.keys]), merged)


def update(table: BucketTable, mapping: DataFrame, target: str, where: Column | None = None) -> list[int]:
    """UPDATE ... FROM mapping(keys, value): `target` becomes the value of its key where the row meets `where`. The first value by sort order counts if a key has several."""

    def set_(old: DataFrame, some: DataFrame) -> DataFrame:
        one = some.groupBy(*table.keys).agg(F.min("value").alias("_value"), F.lit(True).alias("_known"))
        allowed = F.lit(True) if where is None else where
        return old.join(one, [*table.keys], "left").withColumn(target, F.when(allowed & F.col("_known"), F.col("_value")).otherwise(F.col(target)))

    return change(table, mapping.dropna(subset=[*table.keys]), set_)


def fill_missing(table: BucketTable, mapping: DataFrame, target: str) -> list[int]:
    """UPDATE only where the value is missing (blank counts as missing)."""
    return update(table, mapping, target, dml.is_missing(F.col(target)))


def delete(table: BucketTable, gone: DataFrame) -> list[int]:
    """DELETE by key."""
    return change(table, gone.dropna(subset=[*table.keys]), lambda old, some: dml.delete_keys(old, some, table.keys))
