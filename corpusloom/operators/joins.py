"""Joins of the corpus. Sides are left to Spark's statistics: nothing is broadcast by hand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_abstracts(papers: DataFrame, abstracts: DataFrame, key: str = "corpusid") -> DataFrame:
    """Papers that have an abstract, with it."""
    return papers.join(abstracts, key)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """`df` as a table of the catalog, dealt out and sorted by its key once. Joins and groups by the key of tables with equally many buckets move no rows.

    `name` must be free. A task writes a bucket, and adaptive execution can't split a bucket that is joined, so the key should be an id.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids; repeated rows stay."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def absent(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of source whose key (of one or more columns) isn't in target."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def all_within(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether every key of a is in b."""
    return absent(a, b, [key]).isEmpty()


def overridden(df: DataFrame, key: str, column: str, corrections: DataFrame) -> DataFrame:
    """`column` replaced where corrections(key, value) has the key."""
    fixed = corrections.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    return df.join(fixed, F.col(key) == F.col("_key"), "left").withColumn(column, F.coalesce("_value", column)).drop("_key", "_value")


def pairs_within(df: DataFrame, group: str, order: str, *columns: str) -> DataFrame:
    """Pairs of rows of one group, the lesser `order` first; a pair for each two, so `group` has to be a tight block.
    Whether or how well all texts of a large group agree is told by `operators.agreement`, which makes no pairs."""
    side = lambda n: df.select(F.col(group), F.col(order).alias(f"{order}_{n}"), *(F.col(c).alias(f"{c}_{n}") for c in columns))
    return side(1).join(side(2), group).where(F.col(f"{order}_1") < F.col(f"{order}_2"))


def pairs_in_blocks(df: DataFrame, group: str, order: str, *columns: str, block: int = 64) -> DataFrame:
    """As pairs_within(), for groups of any size: a group's rows are dealt into blocks of about `block`, and the pairs of each two blocks are made in a task of their own.
    Rows that are alone in their group aren't joined. The group is told by 128 bits of it."""
    rows = df.where(F.col(group).isNotNull()).select(F.xxhash64(F.lit(1), group).alias("_a"), F.xxhash64(F.lit(2), F.reverse(group)).alias("_b"), F.col(group).alias("_group"), order, *columns)
    sizes = rows.groupBy("_a", "_b").agg(F.ceil(F.count("*") / block).cast("int").alias("_n"), F.count("*").alias("_rows")).where("_rows > 1").drop("_rows")
    own = F.pmod(F.xxhash64(F.lit(7), order), F.col("_n").cast("long")).cast("int")
    dealt = rows.join(sizes, ["_a", "_b"]).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    keys = ["_a", "_b", "_low", "_high"]
    dealt = dealt.select("_a", "_b", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), "_own", "_group", order, *columns)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 200)
    side = lambda n: dealt.select(*keys, F.col("_own").alias(f"_own_{n}"), F.col("_group").alias(f"_group_{n}"), *(F.col(c).alias(f"{c}_{n}") for c in (order, *columns))).repartition(parts, *keys)
    once = (F.col("_low") == F.col("_high")) | (F.col("_own_1") != F.col("_own_2"))
    pairs = side(1).join(side(2).hint("merge"), keys).where(once & (F.col(f"{order}_1") < F.col(f"{order}_2")))
    return pairs.select(F.col("_group_1").alias(group), *(F.col(f"{c}_1") for c in (order, *columns)), *(F.col(f"{c}_2") for c in (order, *columns)))


def matched(requests: DataFrame, responses: DataFrame, key: str = "doi", unknown: str = "UNKNOWN_DOI") -> DataFrame:
    """Every request with its response, without regard to case; `outcome` tells which had none."""
    low = responses.withColumn("_low", F.lower(key)).drop(key)
    return requests.join(low, F.lower(requests[key]) == F.col("_low"), "left").withColumn("outcome", F.when(F.col("_low").isNull(), unknown).otherwise("SUCCESS")).drop("_low")


def fallback(value: Column, *others: tuple[str, Column]) -> tuple[Column, Column]:
    """First filled value, and the name of the source it came from (null if it was there)."""
    filled = lambda c: c.isNotNull() & (F.trim(c) != "")
    found, origin = F.when(filled(value), value), F.lit(None).cast("string")
    name = F.when(filled(value), origin)
    for label, other in others:
        name = F.when(found.isNotNull(), name).otherwise(F.when(filled(other), F.lit(label)))
        found = F.coalesce(found, F.when(filled(other), other))
    return found, name
