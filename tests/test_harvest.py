import json
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import unicode as U
from corpusloom.operators import dml
from corpusloom.plans import catalog, extraction, harvest


def test_harvest_goes_on_where_it_stopped(spark, tmp_path):
    pages, states, mark = f"file://{tmp_path}/pages", f"file://{tmp_path}/states", tmp_path / "down"
    mark.touch()
    fetch = "tests.paged:fetch_marked"
    run = lambda **o: harvest.harvest(spark, [f"ok|{mark}", f"fails|{mark}"], fetch, pages, states, **o)
    first = {r["query"].split("|")[0]: r for r in run(max_pages=1).collect()}
    assert {k: (r.cursor, r.pages, r.finished) for k, r in first.items()} == {"ok": ("c1", 1, False), "fails": ("c1", 1, False)}
    with pytest.raises(RuntimeError, match="ConnectionError"):
        run()
    saved = {r["query"].split("|")[0]: r for r in harvest.state(spark, states).collect()}
    assert (saved["ok"].pages, saved["fails"].pages) == (3, 1)  # the page that failed isn't counted, however often it does
    with pytest.raises(RuntimeError, match="ConnectionError"):
        run()
    assert {r["query"].split("|")[0]: r.pages for r in harvest.state(spark, states).collect()} == {"ok": 3, "fails": 1}
    assert saved["ok"].finished and saved["ok"].records == 3 and saved["fails"].cursor == "c1" and not saved["fails"].finished
    mark.unlink()
    done = {r["query"].split("|")[0]: r for r in run().collect()}
    assert all(r.finished and r.error is None and (r.pages, r.records) == (3, 3) for r in done.values())
    read = spark.read.parquet(pages).where("record is not null")
    assert read.groupBy("query").agg(F.count_distinct("record").alias("n")).where("n = 3").count() == 2
    before = spark.read.parquet(states).count()
    run()
    assert spark.read.parquet(states).count() == before


def test_bucket_queries():
    assert harvest.bucket_queries([(datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, 3, 4, tzinfo=UTC), 5)]) == ["submittedDate:[202401010000 TO 202401020304]"]


def test_lookups_in_batches(spark):
    ids = spark.createDataFrame([(f"e{i}",) for i in range(60)] + [(None,), ("e1",)], "eid string").coalesce(1)

    def client(query):
        asked = [x[4:-1] for x in query.split(" OR ")]
        assert len(asked) <= 25
        if "e30" in asked:
            raise TimeoutError("slow")
        return {x: x.upper() for x in asked if x != "e7"}

    got = harvest.looked_up(ids, client).collect()
    assert len(got) == 62
    by = {r.eid: (r.record, r.outcome) for r in got}
    assert by["e1"] == ("E1", "FOUND") and by["e7"] == (None, "MISSING") and by[None] == (None, "MISSING")
    assert by["e30"] == ("TimeoutError: slow", "FAILED") and by["e59"] == ("E59", "FOUND")


def test_titles_with_greek_letters(spark):
    names = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "θ": "theta", "κ": "kappa", "λ": "lambda", "μ": "mu", "π": "pi", "σ": "sigma", "φ": "phi", "ω": "omega"}
    rows = [(f"x{g}y{g.upper()}z-poly", f"x {n} y {n} z poly") for g, n in names.items()] + [("αβ-poly", "alpha beta poly"), ("ζη", "ζη"), ("  ", None), ("", None), (None, None), ("&amp;lt;b&gt;", "b"), ("<i>CO₂</i>", "co2")]
    got = spark.createDataFrame(rows, "raw string, want string").select("want", U.title_full(F.col("raw")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_year_is_text(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    answers = {"a": {"paper": {"year": "2020"}, "samples": []}, "b": {"paper": {"year": 2021}, "samples": []}}
    got = extraction.flattened(extraction.extracted(texts, lambda t: json.dumps(answers[t]))).orderBy("id").collect()
    assert [r.year for r in got] == ["2020", "2021"]


def test_names_manifests_and_json(spark, tmp_path):
    assert T.quoted_identifier("a`b") == "`a``b`" and T.guarded_name("ab_1") == "ab_1"
    for bad in ("1a", "a b", "a;b", ""):
        with pytest.raises(ValueError, match="table name"):
            T.guarded_name(bad)
    with pytest.raises(ValueError, match="NUL"):
        T.quoted_identifier("a\0")
    given = {"at": datetime(2024, 1, 2, tzinfo=UTC), "path": Path("/x"), "bad": float("nan"), "n": (1, {2}), 3: object}
    safe = catalog.json_safe(given)
    assert safe["at"] == "2024-01-02T00:00:00+00:00" and safe["path"] == "/x" and safe["bad"] is None and safe["n"] == [1, [2]] and "3" in safe
    catalog.write_manifest(spark, f"file://{tmp_path}/m.json", {"a": 1})
    catalog.write_manifest(spark, f"file://{tmp_path}/m.json", given)
    assert json.loads((tmp_path / "m.json").read_text()) == json.loads(json.dumps(safe))


def test_catalog_and_functions(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert ("three_rows", True) in {(r.name, r.temporary) for r in catalog.tables(spark).collect()}
    assert [tuple(r) for r in catalog.columns(spark, "three_rows").collect()] == [(0, "id", "bigint", False)]
    assert catalog.registered(spark, {"shout": lambda x: x and x.upper()}) == ["shout"]
    assert spark.sql("select shout('a')").first()[0] == "A"
    catalog.dropped(spark, "three_rows")
    assert "three_rows" not in {r.name for r in catalog.tables(spark).collect()}


def test_rebuilds_are_checked(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert dml.rebuilt(df, f"file://{tmp_path}/a", lambda d: d.withColumn("w", F.upper("v")), ["id"]).count() == 2
    with pytest.raises(ValueError, match="2 rows became 1"):
        dml.rebuilt(df, f"file://{tmp_path}/b", lambda d: d.limit(1))
    with pytest.raises(ValueError, match="duplicate"):
        dml.rebuilt(df, f"file://{tmp_path}/c", lambda d: d.withColumn("id", F.lit(1)), ["id"])
