"""Filter interaction audit: what each of five filters removes in every order in which they can be applied.

A relational word pipeline: words are exploded, counted by (document, word) and then by document for totals and distinct words; the other flags are joined.
What a filter removes in an order depends only on which of the five a document fails, so 32 conditional counts a part are all that the orders need.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, cut, documents

FILTERS = "ABCDE"
#: Least words; least percent of distinct words; greatest percent of capitals; signs that are not wanted.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"
#: Stands for the document itself among its words. No word holds a space.
ITSELF = " "


def word_totals(rows: DataFrame) -> DataFrame:
    """key, n_words, n_distinct of rows(key, text) for each key; rows that share one have one text.

    Texts are dealt out by key once, and both counts are made where they lie.
    """
    words = F.concat(F.array(F.lit(ITSELF)), F.split("text", f"[{SPACE}]+"))
    each = rows.repartition("key").select("key", F.explode(words).alias("word")).where("word <> ''")
    counted = each.groupBy("key", "word").agg(F.count("*").alias("n"))
    itself = F.col("word") == ITSELF
    totals = counted.groupBy("key").agg(F.sum(F.when(~itself, F.col("n"))).alias("n"), F.count_if(~itself).alias("n_distinct"), F.max(F.when(itself, F.col("n"))).alias("copies"))
    return totals.select("key", F.coalesce(F.expr("n div copies"), F.lit(0)).alias("n_words"), "n_distinct")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of one text, part, mask of the filters A to D and labels: n, n_null (those without a doc_id), first (the least doc_id) and n_first (rows that have it)."""
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(text, 256)
    key = F.substring(F.unhex(F.sha2(F.concat(digest, F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)), 1, 16)
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), digest.alias("digest"), key.alias("key"))
    totals = word_totals(rows.select("key", "text"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    flags = rows.select("key", "doc_id", "part", "digest", (100 * capitals > MAX_CAPITALS * F.length("text")).alias("c"), F.col("text").rlike(SIGNS).alias("d"))
    flags = flags.repartition("key").groupBy("key", "doc_id", "part", "digest", "c", "d").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    told = flags.join(totals, "key", "left").join(marks, "doc_id", "left")
    bits = (F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"), F.col("c"), F.col("d"))
    mask = sum((bit.cast("int") * (1 << i) for i, bit in enumerate(bits)), F.lit(0))
    known = told.select("digest", "part", mask.alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc_id", "n")
    null = F.col("doc_id").isNull()
    return known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("n_null"), F.min("doc_id").alias("first"), F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_first")
    )


def subset_counts(kinds: DataFrame) -> DataFrame:
    """part, and arrays n, good and toxic: of documents that fail exactly the filters of each mask from 0 to 31, how many there are and how many have the label.

    A text's copies fail E but for those with its least doc_id, wherever they stand. They were counted by part before they meet, so a text with very many is few rows.
    """
    least = kinds.groupBy("digest").agg(F.min("first").alias("least"))
    passing = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    both = kinds.join(least, "digest").select("part", "mask", "good", "toxic", passing.alias("passes"), (F.col("n") - passing).alias("fails"))
    columns = {}
    for name, which in (("n", F.lit(True)), ("good", F.col("good")), ("toxic", F.col("toxic"))):
        for m in range(1 << len(FILTERS)):
            columns[f"{name}{m}"] = F.sum(F.when((F.col("mask") == m % 16) & which, F.col("passes" if m < 16 else "fails")).otherwise(0))
    counts = both.groupBy("part").agg(*(c.alias(n) for n, c in columns.items()))
    return counts.select("part", *(F.array(*(F.col(f"{n}{m}") for m in range(1 << len(FILTERS)))).alias(n) for n in ("n", "good", "toxic")))


def _total(counts: str, where) -> Column:
    """Sum of `counts` over the masks for which `where` holds."""
    masks = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    return F.aggregate(masks, F.lit(0).cast("bigint"), lambda total, m: total + F.when(where(m), F.element_at(counts, m + 1)).otherwise(0))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (source), order of the filters and step, with what the filter at that step does.

    Null texts are empty ones: no words, so they fail A only, and E if a smaller doc_id has none either. A null doc_id is smaller or larger than none, so
    that row never fails E and has no labels. Repeated rows are counted each; those that share a doc_id don't make each other fail E. Of several
    labels of a document any one counts. Null sources are the part ''. No rows give no rows. Only doc_id, source and text, and doc_id, quality and toxic of the
    labels are read, so other columns may have any name. Texts are counted whole, however long.
    """
    counts = subset_counts(cut(failures(docs, labels)))
    orders = " ".join("".join(p) for p in itertools.permutations(FILTERS))
    steps = counts.select("*", F.explode(F.split(F.lit(orders), " ")).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(len(FILTERS)))), F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))))
    before = sum((F.when(F.instr("filter_order", f) < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    steps = steps.withColumns({"bit": bit, "before": before})
    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    there = lambda m: m.bitwiseAND(F.col("before")) == 0
    first_of = F.array(*(F.lit(0 if not m else 120 // m.bit_count()) for m in range(1 << len(FILTERS))))  # of 120 orders those in which a given failed filter comes first
    shapley = F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("bigint"), lambda total, m: total + F.when(fails(m), F.element_at("n", m + 1) * F.element_at(first_of, m + 1)).otherwise(0))
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), _total("n", lambda m: there(m) & ~fails(m)).alias("kept"), _total("n", lambda m: there(m) & fails(m)).alias("removed"),
        _total("n", lambda m: ~there(m) & fails(m)).alias("redundant"), F.element_at("n", F.col("bit") + 1).alias("unique_fails"), _total("good", lambda m: there(m) & fails(m)).alias("good_lost"),
        _total("toxic", lambda m: there(m) & fails(m)).alias("toxic_lost"), shapley.alias("shapley"),
    )


ORACLE = """WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, [x for x in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM documents),
fails AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b, 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM words),
lists AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [x for x in [CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END] if x IS NOT NULL] AS failed FROM fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, CAST(s AS INTEGER), 1) AS letter FROM orders, range(1, 6) AS r(s)),
met AS (SELECT part, good, toxic, failed, filter_order, step, letter, coalesce(list_min([instr(filter_order, x) for x in failed]), 6) AS stopped FROM lists, steps),
sums AS (SELECT part, filter_order, step, letter, count(*) FILTER (stopped > step) AS kept, count(*) FILTER (stopped = step) AS removed, count(*) FILTER (list_contains(failed, letter) AND stopped < step) AS redundant,
  count(*) FILTER (failed = [letter]) AS unique_fails, count(*) FILTER (stopped = step AND good) AS good_lost, count(*) FILTER (stopped = step AND toxic) AS toxic_lost FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM sums"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
