"""Runs over dumps with all three levels of tolerance, and functions and writers that no query calls."""

import gzip
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import convert as C
from corpusloom.functions import text as T
from corpusloom.operators import dml, filters
from corpusloom.plans import catalog, quality, queue, runs
from corpusloom.sources import dumps


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def dump(path, lines):
    path.mkdir(exist_ok=True)
    for i in (0, 1):
        with gzip.open(path / f"{i}.jsonl.gz", "wt") as f:
            f.write("\n".join(lines[i::2]) + "\n\n")
    return str(path)


LINES = ['{"corpusid":1,"title":"Poly things"}', '{"corpusid":2,"title":"else"}', '{"corpusid":3,"title":null}', "{broken", '{"corpusid":5,"title":"poly"}', '{"title":"poly without key"}', '{"corpusid":"x","title":"poly"}', '{"corpusid":8,"title":"no"}', '{"corpusid":1,"title":"again POLY"}']
ABSTRACTS = [(1, "a"), (2, "has a polymer"), (3, None), (8, "nothing")]


def test_run_counts_in_one_job(spark, tmp_path):
    records = dumps.jsonl(spark, dump(tmp_path / "in", LINES), "corpusid long, title string")
    abstracts = spark.createDataFrame(ABSTRACTS, "corpusid long, abstract string")
    got = runs.keyword_run(records, abstracts, "poly", f"{tmp_path}/out")
    assert got == {"lines": 9, "bad": 3, "papers": 6, "unmatched": 1, "matched": 5, "passed": 3, "failed": 2}
    read = spark.read.schema("corpusid long, title string, abstract string").json(f"{tmp_path}/out")
    assert rows(read) == rows(spark.createDataFrame([(1, "Poly things", "a"), (1, "again POLY", "a"), (2, "else", "has a polymer")], read.schema))
    assert all(x.suffix == ".gz" for x in (tmp_path / "out").glob("part-*"))
    with pytest.raises(Exception, match="(?i)exist"):
        runs.keyword_run(records, abstracts, "poly", f"{tmp_path}/out")
    none = runs.keyword_run(records.limit(0), abstracts, "poly", f"{tmp_path}/none")
    assert none["lines"] == 0 and none["passed"] == 0


def test_levels_of_tolerance(spark, tmp_path):
    path = dump(tmp_path / "in", LINES)
    schema = "corpusid long, title string"
    kept = dumps.jsonl(spark, path, schema)
    good, counts = dumps.keyed_records(kept.cache(), "corpusid", "title")
    assert rows(counts) == [(9, 3, 1)] and good.count() == 5
    kept.unpersist()
    assert dumps.jsonl(spark, path, schema, "DROPMALFORMED").select("corpusid", "title").distinct().count() == 7
    with pytest.raises(Exception, match="(?i)malformed"):
        dumps.jsonl(spark, path, schema, "FAILFAST").collect()
    dropped = dumps.jsonl(spark, path, schema, "DROPMALFORMED")
    assert runs.keyword_run(dropped, spark.createDataFrame(ABSTRACTS, "corpusid long, abstract string"), "poly", f"{tmp_path}/out") == {"lines": 7, "bad": 1, "papers": 6, "unmatched": 1, "matched": 5, "passed": 3, "failed": 2}


def test_other_dumps(spark, tmp_path):
    paper = {"corpusid": 1, "externalids": {"DOI": "10.1/x"}, "title": "t", "authors": [{"authorId": "7", "name": "N"}], "year": 2020, "isopenaccess": True, "journal": {"name": "J"}}
    author = {"authorid": 7, "externalids": {"ORCID": ["o"]}, "name": "N", "aliases": ["M"], "papercount": 3}
    papers = dumps.as_text(dumps.jsonl(spark, dump(tmp_path / "p", [json.dumps(paper)]), dumps.PAPERS)).first()
    assert (papers.corpusid, json.loads(papers.externalids), json.loads(papers.authors), papers.isopenaccess, papers.year) == (1, {"DOI": "10.1/x"}, [{"authorId": "7", "name": "N"}], 1, 2020)
    authors = dumps.as_text(dumps.jsonl(spark, dump(tmp_path / "a", [json.dumps(author)]), dumps.AUTHORS)).first()
    assert (authors.authorid, json.loads(authors.aliases), json.loads(authors.externalids), authors.papercount) == (7, ["M"], {"ORCID": ["o"]}, 3)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k long, v string")
    dumps.export_jsonl(df, f"{tmp_path}/one", single=True)
    (file,) = (tmp_path / "one").glob("part-*.gz")
    assert sorted(map(json.loads, gzip.open(file, "rt")), key=lambda x: x["k"]) == [{"k": k, "v": v} for k, v in [(1, "a"), (2, "b"), (3, "c")]]
    dumps.export_jsonl(df, f"{tmp_path}/many", mode="overwrite")
    assert rows(spark.read.schema("k long, v string").json(f"{tmp_path}/many")) == rows(df)
    dml.clustered_write(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")), f"{tmp_path}/sorted", "k", 4)
    parts = [[r.k for r in spark.read.parquet(str(p)).collect()] for p in sorted((tmp_path / "sorted").glob("part-*"))]
    assert sum(parts, []) == list(range(1000)) and len(parts) == 4
    assert rows(dml.replace(df.withColumn("s", F.lit(0)), spark.createDataFrame([(1, "new", 1), (1, "newer", 2), (9, "z", 1)], "k long, v string, s int"), ["k"], "s")) == [(1, "newer", 2), (2, "b", 0), (3, "c", 0), (9, "z", 1)]


def test_times_and_flags(spark):
    at = datetime(2024, 3, 1, 12, 30, 5, tzinfo=UTC)
    one = spark.createDataFrame([(at, "2024-03-01T12:30:05Z", "no time", "True", None, ["a"])], "at timestamp, iso string, bad string, flag string, none string, list array<string>")
    got = one.select(
        C.now_iso(F.col("at")), C.iso_time(F.col("iso")) == F.col("at"), C.iso_time(F.col("bad")), C.open_access(F.col("none"), F.col("flag")), C.open_access(F.lit("1"), F.col("none")), C.open_access(F.lit("0"), F.lit("false")),
        C.list_text(F.col("list")), C.flag(F.col("flag") == "True"), C.now_iso().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$"),
    ).first()
    assert tuple(got) == ("2024-03-01T12:30:05+00:00", True, None, True, True, False, '["a"]', 1, True)


def test_histories(spark):
    entry = lambda n: {"source": "wiley", "status": "failed", "error": f"E{n}", "attempt": n, "timestamp": "t"}
    texts = [(json.dumps([entry(1), entry(2)]), 2), (json.dumps([entry(1)]), 2), ("[]", 0), (None, 0), ("not json", 1), ("", 1)]
    got = spark.createDataFrame(texts, "h string, n long").select(C.history_length(F.col("h")), C.history_agrees(F.col("h"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(2, True), (1, False), (0, True), (0, True), (None, False), (0, False)]
    grown = spark.createDataFrame([(json.dumps([entry(1)]),)], "h string").select(C.append_attempt(C.history(F.col("h")), F.lit("arxiv"), F.lit("failed"), F.lit("E2"), F.lit(2), F.lit("t")).alias("h")).first().h
    assert [(x.source, x.attempt) for x in grown] == [("wiley", 1), ("arxiv", 2)]


def test_search_counters_and_urls(spark):
    text = json.dumps({"search-results": {"opensearch:totalResults": "1234", "opensearch:startIndex": "0", "opensearch:itemsPerPage": "25"}})
    df = spark.createDataFrame([(text,), ("{}",)], "r string")
    assert [tuple(r) for r in df.select(*C.search_counters(F.col("r"))).collect()] == [(1234, 0, 25), (None, None, None)]
    got = df.limit(1).select(T.candidates(F.lit("b"), F.lit(""), F.lit(None).cast("string"), F.lit("a"), F.lit("b")).alias("c"), T.starts_with_any(F.lit("10.1/x"), ["10.2/", "10.1/"]), T.starts_with_any(F.lit(None).cast("string"), ["a"])).first()
    assert tuple(got) == (["b", "a"], True, False)


def test_registry_checks(spark):
    df = spark.createDataFrame([("ID1", '["arxiv_x"]', "arxiv_x"), ("ID2", '["arxivZx"]', "arxiv_x"), ("ID3", '["b","arxiv_x"]', "arxiv_x")], "paper_uid string, source_order string, canonical_source string")
    assert [r.paper_uid for r in filters.inconsistent_order(df).orderBy("paper_uid").collect()] == ["ID2", "ID3"]
    assert quality.contract(df, ["paper_uid", "doi", "year"]) == ["doi", "year"]
    assert quality.schema_report({"a": df.select("paper_uid")}) == [("a", "paper_uid", "string", True)]
    done = spark.createDataFrame([("success", "/p", "xml", None, "[]"), ("success", " ", None, "E", '[{"attempt":1}]'), ("failed", None, None, "E", None)], "download_status string, fulltext_path string, fulltext_format string, last_error string, failure_history string")
    assert {r.metric: r["count"] for r in quality.success_audit(done).collect()} == {"success_rows": 2, "missing_path": 1, "missing_format": 1, "with_last_error": 1, "with_history": 1}


def test_files_that_are_there_already(spark):
    pending = spark.createDataFrame([("ID1", "wiley"), ("ID2", "arxiv")], "paper_uid string, canonical_source string")
    at = datetime(2024, 1, 1, tzinfo=UTC)
    files = spark.createDataFrame([("ID1", "/a.pdf", "pdf", True, "unused", at), ("ID2", "/b.pdf", "pdf", False, "truncated", at), ("ID9", "/c", "pdf", True, None, at)], "paper string, path string, format string, ok boolean, reason string, at timestamp")
    tries = queue.reconciled(pending, files)
    assert tries.columns == [c.split()[0] for c in queue.ATTEMPT.split(", ")]
    assert rows(tries.select("paper", "source", "ok", "error")) == [("ID1", "wiley", True, None), ("ID2", "arxiv", False, "truncated")]
    assert {r.paper: r.download_status for r in queue.fold(tries).collect()} == {"ID1": "success", "ID2": "failed"}


def test_statistics_for_the_optimizer(spark, tmp_path):
    spark.range(50).write.option("path", f"file://{tmp_path}/t").saveAsTable("counted_rows")
    try:
        catalog.analyzed(spark, "counted_rows")
        assert "50 rows" in {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED counted_rows").collect()}["Statistics"]
    finally:
        catalog.dropped(spark, "counted_rows")
