import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import buckets, dml, joins

SCHEMA = "k long, v string, s long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    """Data files of each bucket with their contents' times."""
    found = {}
    for folder, _, names in os.walk(path):
        if (data := {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}) or "_bucket=" in folder:
            found[int(folder.rpartition("=")[2])] = data
    return found


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), "id")).alias("v"), F.lit(0).cast("long").alias("s"))
    return buckets.create(df, f"file://{tmp_path}/t", ["k"], 64), df


def test_upsert_of_one_percent_leaves_other_buckets(spark, table, tmp_path):
    table, df = table
    before = files(f"{tmp_path}/t")
    assert len(before) == 64 and all(len(x) == 1 for x in before.values())
    new = spark.range(30).select((F.col("id") * 101).alias("k"), F.lit("new").alias("v"), F.col("id").alias("s")).union(spark.createDataFrame([(101, "last", 99), (None, "none", 1), (5000, "added", 1)], SCHEMA))
    touched = buckets.upsert(table, new, "s")
    after = files(f"{tmp_path}/t")
    assert 1 < len(touched) < 40 and {b for b in before if after[b] != before[b]} == {*touched}
    assert rows(table.read(spark)) == rows(dml.upsert(df, new.dropna(), ["k"], "s"))
    again = files(f"{tmp_path}/t")
    assert buckets.upsert(table, new.limit(0), "s") == [] and files(f"{tmp_path}/t") == again


def test_other_changes(spark, table, tmp_path):
    table, df = table
    want = df
    new = spark.createDataFrame([(1, "old", 5), (7000, "b", 2), (7000, "a", 1), (None, "x", 1)], SCHEMA)
    touched = buckets.insert_ignore(table, new, F.col("s"))
    want = dml.insert_ignore(want, new, ["k"], F.col("s"))
    assert rows(table.read(spark)) == rows(want) and len(touched) <= 2
    values = spark.createDataFrame([(5, "filled"), (6, "not this"), (9999, "no row"), (5, "later")], "k long, value string")
    buckets.fill_missing(table, values, "v")
    got = {r.k: r.v for r in table.read(spark).collect()}
    assert got[5] == "filled" and got[6] == "v6" and got[10] is None and 9999 not in got
    buckets.update(table, values, "v", F.col("k") > 5)
    assert {r.k: r.v for r in table.read(spark).collect()} == got | {6: "not this"}
    buckets.delete(table, spark.createDataFrame([(5,), (6,), (None,), (12345,)], "k long"))
    assert {r.k for r in table.read(spark).collect()} == got.keys() - {5, 6}


def test_emptied_buckets_are_gone(spark, tmp_path):
    df = spark.createDataFrame([(i, "x", 0) for i in range(5)], SCHEMA)
    table = buckets.create(df, f"file://{tmp_path}/t", ["k"], 64)
    buckets.delete(table, df.where("k < 3").select("k"))
    assert rows(table.read(spark)) == [(3, "x", 0), (4, "x", 0)]
    buckets.delete(table, df.select("k"))
    assert table.read(spark).collect() == []
    buckets.upsert(table, df, "s")
    assert rows(table.read(spark)) == rows(df)
    with pytest.raises(Exception, match="already exists"):
        buckets.create(df, f"file://{tmp_path}/t", ["k"], 64)


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    papers = spark.range(2000).select(F.col("id").alias("corpusid"), F.concat(F.lit("t"), "id").alias("title"))
    abstracts = spark.range(0, 3000, 3).select(F.col("id").alias("corpusid"), F.concat(F.lit("a"), "id").alias("abstract"))
    a, b = (joins.bucketed(df, n, "corpusid", 8, f"file://{tmp_path}/{n}") for df, n in ((papers, "bucketed_papers"), (abstracts, "bucketed_abstracts")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.with_abstracts(a, b)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in joins.with_abstracts(papers, abstracts)._jdf.queryExecution().executedPlan().toString()
        assert rows(joined) == rows(joins.with_abstracts(papers, abstracts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in ("bucketed_papers", "bucketed_abstracts"):
            spark.sql(f"DROP TABLE IF EXISTS {n}")
