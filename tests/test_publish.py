import threading

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dml
from corpusloom.plans import constraints, publish
from corpusloom.plans.constraints import Check, NotNull, Unique


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_versions_are_swapped_after_the_checks(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        publish.read(spark, root)
    first = publish.publish(spark.range(10), root, publish.same_rows)
    before = publish.read(spark, root)
    publish.publish(spark.range(10).withColumn("w", F.lit(1)), root, publish.same_rows, lambda new, old: dml.unique_or_raise(new, ["id"]))
    assert publish.read(spark, root).columns == ["id", "w"] and before.count() == 10
    with pytest.raises(ValueError, match="10 rows became 3"):
        publish.publish(spark.range(3), root, publish.same_rows)
    with pytest.raises(ValueError, match="duplicate"):
        publish.publish(spark.range(10).withColumn("id", F.lit(1)), root, lambda new, old: dml.unique_or_raise(new, ["id"]))
    assert publish.read(spark, root).columns == ["id", "w"]
    gone = publish.recover(spark, root)
    assert len(gone) == 2 and publish.read(spark, root).count() == 10 and spark.read.parquet(first).count() == 10
    assert len(publish.recover(spark, root, keep=0)) == 2 and publish.read(spark, root).columns == ["id", "w"]


def test_a_writer_that_dies_before_the_swap(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    publish.publish(spark.range(4), root)
    monkeypatch.setattr(publish, "mark", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        publish.publish(spark.range(9), root)
    monkeypatch.undo()
    assert publish.read(spark, root).count() == 4
    assert len(publish.recover(spark, root)) == 1 and publish.read(spark, root).count() == 4
    publish.publish(spark.range(9), root)
    assert publish.read(spark, root).count() == 9


def test_readers_see_old_or_new(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    publish.publish(spark.range(100).select(F.lit(0).alias("v")), root)
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            seen.append(tuple(publish.read(spark, root).agg(F.min("v"), F.max("v"), F.count("*")).first()))

    reader = threading.Thread(target=watch)
    reader.start()
    try:
        for i in range(1, 4):
            publish.publish(spark.range(100).select(F.lit(i).alias("v")), root, publish.same_rows)
    finally:
        stop.set()
        reader.join()
    assert seen and all(a == b and n == 100 for a, b, n in seen)
    assert [x[0] for x in seen] == sorted(x[0] for x in seen)


def papers(spark):
    base = ("ID1", "doi", "a", "a", None, "[]", 1, "[]", "s", "pending", 0)
    wrong = [{0: "ID2", 2: "b", 3: "b"}, {2: "c", 3: "c"}, {0: "ID3", 3: None, 2: "d"}, {0: "ID4", 1: "pmid", 2: "e", 3: "e"}, {0: "ID5", 2: "f", 3: "a"}, {0: "ID6", 2: "g", 3: "g", 9: "open"}, {0: "ID7", 2: "h", 3: "h", 9: None}]
    wrong += [{0: "ID8", 1: "arxiv_id", 2: "x", 3: None, 4: "x"}, {0: "ID9", 1: "arxiv_id", 2: "y", 3: None, 4: "x"}, {0: "ID10", 2: "i", 3: "i", 4: "x"}, {0: None, 2: "j", 3: "j"}, {0: None, 2: "k", 3: "k"}]
    made = [base] + [tuple(w.get(i, x) for i, x in enumerate(base)) for w in wrong]
    return spark.createDataFrame([(n, *r) for n, r in enumerate(made)], "n int, paper_uid string, identifier_type string, identifier_value string, doi string, arxiv_id string, sources string, source_count int, source_order string, canonical_source string, download_status string, attempt_count int")


def test_rows_that_break_constraints_go_to_quarantine(spark, tmp_path):
    df = papers(spark)
    path = f"file://{tmp_path}/t"
    counts = constraints.load(df, constraints.PAPERS, ["n"], path)
    bad = {r.n: r.broken for r in constraints.loaded(spark, path, valid=False).collect()}
    assert bad == {2: ["paper_uid_unique"], 3: ["identifier_present"], 4: ["identifier_type_known", "identifier_present"], 5: ["doi_unique"], 6: ["download_status_known"], 7: ["download_status_given"], 9: ["arxiv_id_unique"], 11: ["paper_uid_given"], 12: ["paper_uid_given"]}
    good = constraints.loaded(spark, path)
    assert good.columns == df.columns and {r.n for r in good.collect()} == {0, 1, 8, 10}
    assert counts["good"] == 4 and sum(counts.values()) - 4 == sum(map(len, bad.values()))
    assert {r.rule: r.rows for r in constraints.violations(df, constraints.PAPERS, ["n"]).collect()} == {k: v for k, v in counts.items() if k != "good"}
    assert constraints.violations(df.limit(0), constraints.PAPERS, ["n"]).agg(F.sum("rows")).first()[0] == 0


def test_a_rule_that_leaves_most_rows_out(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 5, 1).alias("k"))
    rules = [Unique("k", ("k",)), Unique("none", ("id",), "id < 0"), Check("small", "id < 1990"), NotNull("given", "k")]
    assert {r.rule: r.rows for r in constraints.violations(df, rules, ["id"]).collect()} == {"k": 4, "none": 0, "small": 10, "given": 1995}
