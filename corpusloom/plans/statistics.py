"""Statistics of staging records, registry and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.convert import percent
from ..functions.text import is_filled_sql
from ..functions.unicode import title_full


def per_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(
        F.count("*").alias("records"), F.count_if(is_filled_sql(F.col("title"))).alias("with_title"), F.countDistinct(F.lower(F.trim("identifier_value"))).alias("unique_values"),
        F.count_if(F.col("doi").isNull()).alias("missing_doi"), F.countDistinct("doi").alias("unique_dois"),
    )


def summary(df: DataFrame) -> DataFrame:
    """Counts of the whole table in one row and one pass."""
    return df.agg(
        F.count("*").alias("total"), F.count("doi").alias("with_doi"), F.sum(F.when(F.col("identifier_type") == "arxiv_id", 1).otherwise(0)).alias("arxiv_rows"),
        F.count_if(F.trim(F.coalesce("title", F.lit(""))) == "").alias("blank_titles"), F.max("source_priority").alias("worst_priority"), F.countDistinct(F.when(F.col("identifier_type") == "doi", F.col("identifier_value"))).alias("distinct_dois"),
    )


def sources_of(df: DataFrame) -> DataFrame:
    """How many sources have each paper: distinct pairs first, so that no group holds its rows."""
    return df.select("identifier_key", "source").distinct().groupBy("identifier_key").agg(F.count("*").alias("n"))


def overlap(df: DataFrame) -> DataFrame:
    return sources_of(df).agg(F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") >= 2).alias("shared"), F.max("n").alias("most"))


def source_counts(df: DataFrame) -> DataFrame:
    return shares(sources_of(df).withColumnRenamed("n", "source_count"), "source_count")


def shares(df: DataFrame, column: str) -> DataFrame:
    """Papers of each value and their percentage; the total is a window over the few groups."""
    counted = df.groupBy(column).agg(F.count("*").alias("papers"))
    return counted.withColumn("share", percent(F.col("papers"), F.sum("papers").over(Window.partitionBy(F.lit(0)))))


def combinations(df: DataFrame) -> DataFrame:
    """How often each ordered list of sources occurs; a list is as long as there are sources."""
    pairs = df.select("identifier_key", "source", "source_priority").distinct()
    listed = pairs.groupBy("identifier_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_priority", "source"))), lambda s: s["source"]), " -> ").alias("combination"))
    return listed.groupBy("combination").agg(F.count("*").alias("papers"))


def pair_overlap(df: DataFrame) -> DataFrame:
    """Papers that two sources share, for every two sources, also where it is none.

    A paper's sources are one short array, and the pairs come from it: no join of the papers with themselves.
    """
    listed = df.groupBy("identifier_key").agg(F.array_sort(F.collect_set("source")).alias("s"))
    pairs = listed.where(F.size("s") > 1).select(F.explode(F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("source_a"), b.alias("source_b")))))).alias("p"))
    counts = pairs.groupBy("p.source_a", "p.source_b").agg(F.count("*").alias("n"))
    names = df.groupBy("source").agg(F.count("*").alias("_")).agg(F.array_sort(F.collect_list("source")).alias("s"))
    every = names.select(F.explode(F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("source_a"), b.alias("source_b")))))).alias("p")).select("p.*")
    return every.join(counts, ["source_a", "source_b"], "left").select("source_a", "source_b", F.coalesce("n", F.lit(0)).alias("shared"))


def multiplicity(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1").groupBy("copies").agg(F.count("*").alias("groups"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, rows beyond the first of a key, and keys that repeat: one aggregation over grouped counts."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    real = F.col(key).isNotNull()
    return counts.agg(F.sum("n").alias("total"), F.count_if(real).alias("unique_dois"), F.sum(F.when(real, F.col("n") - 1).otherwise(0)).alias("surplus"), F.count_if(real & (F.col("n") > 1)).alias("repeated"))


def title_groups(df: DataFrame) -> DataFrame:
    g = df.groupBy("identifier_key").agg(F.count("*").alias("n"), F.countDistinct("title").alias("t")).where("n > 1")
    return g.agg(F.count_if(F.col("t") == 1).alias("same_title"), F.count_if(F.col("t") > 1).alias("other_title"))


def groups(df: DataFrame, key: str) -> DataFrame:
    """Rows, sources, ids and the first title of each key. The ids are one text, as long as the group: a report of copies, where a key names one paper."""
    ids = F.array_sort(F.collect_list("staging_id"))
    sources = F.array_sort(F.collect_set("source"))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"), F.size(sources).cast("bigint").alias("source_count"), F.array_join(sources, ",").alias("sources"), F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"), F.min_by("title", "staging_id").alias("first_title"))


def title_lists(df: DataFrame, key: str, title: str = "title") -> DataFrame:
    """Rows of each key, and its different titles: as they are and normalised, each in order. A key has few titles, as it names one paper."""
    raw, plain = F.array_sort(F.collect_set(title)), F.array_sort(F.collect_set("_plain"))
    named = df.where(F.col(key).isNotNull()).withColumn("_plain", title_full(F.col(title)))
    return named.groupBy(key).agg(F.count("*").alias("row_count"), F.size(raw).cast("bigint").alias("title_count"), F.size(plain).cast("bigint").alias("normalised_count"), F.array_join(raw, "|").alias("titles"), F.array_join(plain, "|").alias("normalised"))


def titles_as_seen(df: DataFrame, key: str, order: str, title: str = "title") -> DataFrame:
    """Rows of each key, its first title, and its different titles in the order in which they first came; a null title is none."""
    seen = df.where(F.col(key).isNotNull()).groupBy(key, F.col(title).alias("_title")).agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_title").isNotNull(), F.struct("_first", "_title"))))
    out = seen.groupBy(key).agg(F.sum("_n").alias("row_count"), F.min_by("_title", "_first").alias("first_title"), listed.alias("_listed"))
    return out.select(key, "row_count", "first_title", F.size("_listed").cast("bigint").alias("title_count"), F.array_join(F.transform("_listed", lambda t: t["_title"]), "|").alias("titles"))


def agreement(df: DataFrame, a: Column, b: Column, digits: int = 6) -> DataFrame:
    """Share of equal binary labels and Cohen's kappa (1 if chance alone would agree always)."""
    x, y = a.cast("double"), b.cast("double")
    one = df.agg(F.avg((a == b).cast("double")).alias("po"), F.avg(x).alias("p"), F.avg(y).alias("q"))
    pe = F.col("p") * F.col("q") + (1 - F.col("p")) * (1 - F.col("q"))
    return one.select(F.round("po", digits).alias("agreement"), F.round(F.when(pe == 1, 1.0).otherwise((F.col("po") - pe) / (1 - pe)), digits).alias("kappa"))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts of `column`'s values per `row`, 0 where there are none; the values are given, so no extra pass finds them."""
    return df.groupBy(row).agg(*(F.count_if(F.coalesce(F.col(column) == v, F.lit(False))).alias(f"{column}_{v}") for v in values))


def terms(df: DataFrame, group: str, text: Column, sep: str) -> DataFrame:
    exploded = df.select(group, F.explode(F.split(text, sep)).alias("t")).select(group, F.trim("t").alias("term"))
    return exploded.where("term <> ''").groupBy(group, "term").agg(F.count("*").alias("n"))


def containment(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) where a document contains an item's whole text.

    The inner words of an item stand as whole words in a document that contains it, so candidates share a run of up to four of them, found by an
    equi-join of hashes; only candidates are compared. Items of one or two words share a run of their characters instead.
    """
    words = lambda c: F.split(c, r"\s+")
    items = items.where(F.length("text") > 0).select("item_id", F.col("text").alias("item"))
    long, short = items.where(F.size(words(F.col("item"))) > 2), items.where(F.size(words(F.col("item"))) <= 2)
    width = F.least(F.size(words(F.col("item"))) - 2, F.lit(4))
    keyed = long.select("item_id", width.alias("k"), F.xxhash64(F.slice(words(F.col("item")), F.lit(2), width)).alias("key"))
    runs = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: F.struct(k.alias("k"), F.xxhash64(F.slice("w", i, k)).alias("key"))))
    listed = docs.select("doc_id", F.explode(F.array(words(F.col("text")))).alias("w"))  # a generator, so that the text is split once
    at = listed.select("doc_id", F.explode(F.flatten(runs)).alias("r")).select("doc_id", "r.k", "r.key")
    found = at.join(keyed, ["k", "key"]).select("doc_id", "item_id")
    for n in sorted(r["n"] for r in short.select(F.least(F.length("item"), F.lit(32)).alias("n")).distinct().collect()):  # at most 32 lengths
        chars = F.transform(F.sequence(F.lit(1), F.length("text") - (n - 1)), lambda i, n=n: F.xxhash64(F.substring("text", i, F.lit(n))))
        places = docs.where(F.length("text") >= n).select("doc_id", F.explode(F.array_distinct(chars)).alias("key"))
        these = short.where(F.least(F.length("item"), F.lit(32)) == n).select("item_id", F.xxhash64(F.substring("item", 1, n)).alias("key"))
        found = found.unionByName(places.join(these, "key").select("doc_id", "item_id"))
    near = found.distinct().join(docs.select("doc_id", "text"), "doc_id").join(items, "item_id")
    return near.where(F.contains("text", "item")).select("doc_id", "item_id")
