import gzip
import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.operators import dedup, dml, filters, joins, numbering, setops
from corpusloom.plans import enrichment, extraction, quality, queue, registry
from corpusloom.sources import dumps
from corpusloom.sources.pages import CursorPages
from corpusloom.streaming import events as streaming

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_of_the_known_example(spark):
    doi = "10.1000/abc123"
    raw = [(1, "springer_nature", doi, None, "T", "A"), (2, "europepmc", doi, None, "T2", None), (3, "s2orc", doi, None, " ", "A3"), (4, "arxiv", doi, "2401.12345", None, None), (5, "arxiv", None, "2501.01234", "X", ""), (6, "arxiv", None, None, "Y", ""), (7, "s2orc", doi, None, "later", "later")]
    df = spark.createDataFrame(raw, "staging_id long, source string, doi string, arxiv_id string, title string, abstract string").join(registry.priorities(spark), "source")
    out = registry.merged(registry.staged(df))
    got = [(r.paper_uid, r.identifier_type, r.identifier_value, r.canonical_source, r.sources, r.source_count, r.download_status) for r in out.orderBy("paper_id").collect()]
    assert got == [
        ("ID000000001", "doi", doi, "springer_nature", '["springer_nature","europepmc","s2orc","arxiv"]', 4, "pending"),
        ("ID000000002", "arxiv_id", "2501.01234", "arxiv", '["arxiv"]', 1, "pending"),
    ]
    assert out.where("paper_id = 1").first().arxiv_id == "2401.12345"
    assert rows(registry.merged(registry.staged(df.orderBy(F.rand(1)))).drop("x")) == rows(out)
    assert all(r.passed for r in quality.checks(out).collect())


def test_broken_registry_is_noticed(spark):
    df = spark.createDataFrame([("ID1", "doi", "a", "a", None, '["x"]', 1, '["y"]', "x", "pending", 0), ("ID1", "doi", "", None, None, '["x"]', 2, '["x"]', None, "failed", 0)], "paper_uid string, identifier_type string, identifier_value string, doi string, arxiv_id string, sources string, source_count long, source_order string, canonical_source string, download_status string, attempt_count int")
    found = {r["check"]: r.issue_count for r in quality.checks(df).collect()}
    assert found["duplicate_uid"] == 1 and found["wrong_source_count"] == 1 and found["missing_identifier"] == 1 and found["order_not_canonical"] == 2 and found["wrong_initial_status"] == 1


def test_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "x", 1), (3, "y", 2), (3, "z", 1), (None, "n", 3)], "k long, v string, s int")
    assert rows(dml.insert_ignore(old.withColumn("s", F.lit(0)), new, ["k"], F.col("s"))) == [(1, "a", 0), (2, "b", 0), (3, "z", 1)]
    assert rows(dml.upsert(old.withColumn("s", F.lit(0)), new.dropna(), ["k"], "s")) == [(1, "a", 0), (2, "x", 1), (3, "y", 2)]
    assert rows(dml.delete_keys(old, new, ["k"])) == [(1, "a")]
    assert rows(old.select("k", dml.fill_missing(old, "v", F.lit("f")))) == rows(old)
    wide = dml.schema_synced(old, StructType([StructField("k", LongType()), StructField("w", StringType())]))
    assert wide.columns == ["k", "v", "w"]
    with pytest.raises(TypeError):
        dml.schema_synced(old, StructType([StructField("k", StringType())]))
    with pytest.raises(ValueError):
        dml.unique_or_raise(old.union(old), ["k"])
    with pytest.raises(ValueError):
        filters.pick(old, ["nope"])


def test_copies_refuse_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("d", "t", None), ("d", " ", "a"), ("d", "t", "a")], "doi string, title string, abstract string")
    path = f"{tmp_path}/clean"
    assert dml.cleaned_copy(df, ["doi"], ["doi", "title", "abstract"], path) == {"total": 3, "accepted": 1, "rejected": 2}
    with pytest.raises(Exception, match="(?i)exist"):
        dml.cleaned_copy(df, ["doi"], ["title"], path)
    assert dml.cleaned_copy(df, ["doi"], ["title"], path, overwrite=True)["accepted"] == 2


def test_anti_and_semi_make_the_whole(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    both = joins.among(docs, labels, "doc_id").union(joins.absent(docs, labels, ["doc_id"]))
    assert rows(both.select("doc_id")) == rows(docs.select("doc_id"))
    assert joins.all_within(labels, docs, "doc_id") and not joins.all_within(docs, labels, "doc_id")


def test_dedup_is_idempotent_and_numbers_are_dense(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "source")
    once = dedup.keep_first(docs, ["lang", "source"], F.col("doc_id"))
    assert rows(dedup.keep_first(once, ["lang", "source"], F.col("doc_id"))) == rows(once)
    got = numbering.numbered(docs, "n", F.col("lang"), F.col("doc_id"), parts=7).orderBy("lang", "doc_id").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert rows(dedup.sample_n(docs, ["lang"], 3, 1, "doc_id")) == rows(dedup.sample_n(docs.repartition(5), ["lang"], 3, 1, "doc_id"))
    assert setops.split_union(docs, F.col("lang") == "en", lambda x: x.limit(0)).where("lang = 'en'").count() == 0


def test_enrichment_precedence(spark):
    papers = spark.createDataFrame([("DOI:10.1/A", "have", None, 0), ("10.1/a", None, None, 0), ("10.1/b", " ", None, None), ("10.1/c", None, None, 0), ("10.1/a", None, None, 1)], "doi string, abstract string, abstract_source string, doi_tested int")
    papers = papers.withColumns({c: F.lit(None).cast("string") for c in ("authors_enriched", "authors_source", "affiliations_enriched", "affiliations_source")})
    message = "message struct<abstract:string,author:array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>>"
    crossref = enrichment.crossref_fields(spark.createDataFrame([("10.1/A", ("<p>cr &lt; x</p>", [("A", "B", None, None)]))], f"doi string, {message}"))
    openalex = enrichment.openalex_fields(spark.createDataFrame([("10.1/b", {"oa": [0]}, None), ("10.1/a", {"no": [0]}, None)], "doi string, abstract_inverted_index map<string,array<int>>, authorships array<struct<author:struct<display_name:string>,institutions:array<struct<display_name:string>>,raw_affiliation_strings:array<string>>>"))
    got = enrichment.enriched(papers, crossref, openalex)
    assert rows(got.select("doi", "abstract", "abstract_source", "authors_enriched", "authors_source", "doi_tested")) == sorted([("DOI:10.1/A", "have", None, "A B", "crossref", 1), ("10.1/a", "cr < x", "crossref", "A B", "crossref", 1), ("10.1/b", "oa", "openalex", None, None, 1), ("10.1/c", None, None, None, None, 1), ("10.1/a", None, None, None, None, 1)], key=str)


def test_date_buckets_hold_at_most_the_limit(spark):
    ev = spark.read.parquet(f"{DATA}/events.parquet")
    start, end = datetime(2023, 1, 1, tzinfo=UTC), datetime(2026, 1, 1, tzinfo=UTC)
    found = enrichment.date_buckets(ev, "ts", 100, start, end)
    assert sum(n for *_, n in found) == ev.count() and all(0 < n <= 100 for *_, n in found)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_date_buckets_equal_recursive_halving(spark):
    rng = random.Random(3)
    start, end = datetime(1991, 1, 1, 0, 0, 30, tzinfo=UTC), datetime(2026, 7, 3, 11, 7, tzinfo=UTC)
    low, high = int(start.timestamp() // 60), -(-int(end.timestamp()) // 60)
    burst = int(datetime(2020, 2, 2, tzinfo=UTC).timestamp())
    seconds = [rng.randrange(int(start.timestamp()), int(end.timestamp())) for _ in range(300)] + [burst] * 40 + [burst + rng.randrange(7200) for _ in range(200)]
    df = spark.createDataFrame([(s,) for s in seconds] + [(0,), (None,)], "s long").select(F.timestamp_seconds("s").alias("ts"))

    def halve(a, z, inside):
        if not inside:
            return []
        if len(inside) <= 9 or z - a <= 3:
            return [(a, z, len(inside))]
        m = (a + z) // 2
        return halve(a, m, [x for x in inside if x < m]) + halve(m, z, [x for x in inside if x >= m])

    got = enrichment.date_buckets(df, "ts", 9, start, end, 3)
    assert [(int(a.timestamp()) // 60, int(z.timestamp()) // 60, n) for a, z, n in got] == halve(low, high, [s // 60 for s in seconds])
    assert max(n for *_, n in got) >= 40
    assert enrichment.date_buckets(df.limit(0), "ts", 9, start, end) == []
    assert enrichment.date_buckets(df, "ts", 1000, start, end) == [(start.replace(second=0), end, len(seconds))]


def test_queue_states(spark):
    at = datetime(2024, 1, 1, tzinfo=UTC)
    log = spark.createDataFrame([("ID1", "wiley", False, "E", None, "pdf", at, 1), ("ID1", "wiley", True, None, "/p", "pdf", at, 2), ("ID2", "arxiv", False, "X", None, "pdf", at, 1)], queue.ATTEMPT)
    state = {r.paper: r for r in queue.fold(log).collect()}
    assert (state["ID1"].download_status, state["ID1"].attempt_count, state["ID1"].last_error, state["ID1"].fulltext_path, state["ID1"].attempted_sources) == ("success", 2, None, "/p", '["wiley","wiley"]')
    assert [h["attempt"] for h in json.loads(state["ID1"].failure_history)] == [1] and state["ID2"].last_error == "X"
    papers = spark.createDataFrame([("ID1", "pending", 0), ("ID3", "pending", 0)], "paper_uid string, download_status string, attempt_count long")
    assert rows(queue.applied(papers, queue.fold(log)).select("paper_uid", "download_status", "attempt_count")) == [("ID1", "success", 2), ("ID3", "pending", 0)]


def test_sources(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"corpusid":1,"abstract":"x"}\nbad\n\n{"abstract":"y"}\n{"corpusid":2,"abstract":""}\n{"corpusid":3,"abstract":" "}\n')
    good, counts = dumps.keyed_records(dumps.jsonl(spark, str(tmp_path / "a.jsonl.gz"), dumps.ABSTRACTS), "corpusid", "abstract")
    assert rows(good) == [(1, "x"), (3, " ")] and tuple(counts.first()) == (5, 2, 1)
    (tmp_path / "s.json").write_text(json.dumps({"search-results": {"entry": [{"eid": "e1", "prism:doi": "10.1/x", "dc:title": "T", "openaccessFlag": True, "affiliation": [{"affilname": "A", "affiliation-city": "B", "affiliation-country": "C"}]}, {"error": "x"}]}}))
    assert [(r.eid, r.doi, r.open_access_flag, r.affiliation) for r in dumps.scopus_papers(spark, str(tmp_path / "s.json")).collect()] == [("e1", "10.1/x", 1, "A, B, C")]
    (tmp_path / "e.json").write_text(json.dumps({"resultList": {"result": [{"pmcid": "PMC1", "pubYear": "2020", "isOpenAccess": "Y", "journalInfo": {"journal": {"title": "J"}}}, {"doi": "d"}]}}))
    assert [(r.pmcid, r.publication_year, r.is_open_access, r.has_pdf, r.journal) for r in dumps.europepmc_papers(spark, str(tmp_path / "e.json")).collect()] == [("PMC1", 2020, 1, None, "J")]
    (tmp_path / "f.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2101.1v1</id></entry></feed>')
    assert [r.arxiv_id for r in dumps.arxiv_papers(spark, str(tmp_path / "f.xml")).collect()] == ["2101.1"]
    for folder, n in (("one", 1), ("two", 2)):
        (tmp_path / "md" / folder).mkdir(parents=True)
        for i in range(n):
            (tmp_path / "md" / folder / f"{i}.md").write_text(f"# {folder}\n")
    assert [r.text for r in dumps.markdown_folders(spark, str(tmp_path / "md")).collect()] == ["# one"]
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    assert rows(dumps.tsv(spark, str(tmp_path / "t.tsv"))) == [("1", "x")]
    files = spark.createDataFrame([("fixed.tsv", "u"), ("g_2020.zip", "v"), ("other", "w"), ("g_2021.zip", "z")], "name string, url string")
    assert rows(dumps.manifest(files, ["fixed.tsv"], r"g_\d{4}\.zip", files.where("name = 'g_2021.zip'"))) == [("fixed.tsv", "u"), ("g_2020.zip", "v")]
    with pytest.raises(ValueError):
        dumps.manifest(files, ["lost"], "x", files)


def test_cursor_pages(spark):
    spark.dataSource.register(CursorPages)
    df = spark.read.format("cursorpages").option("fetch", "tests.paged:fetch").option("queries", '["q", "same"]').load()
    assert rows(df.select("query", "page", "record")) == [("q", 0, '{"a":1}'), ("q", 0, '{"a":2}'), ("q", 1, '{"a":3}'), ("same", 0, '{"a":9}')]


def test_extraction_hooks(spark):
    papers = spark.createDataFrame([(1, "t", "a"), (2, None, "a"), (3, "t", " ")], "id int, title string, abstract string")

    def fails(prompts):
        raise OSError

    assert rows(extraction.classified(papers, lambda p: [True] * len(p)).select("id", "is_match")) == [(1, True), (2, False), (3, False)]
    assert rows(extraction.classified(papers, fails).select("id", "is_match")) == [(1, False), (2, False), (3, False)]
    out = extraction.extracted(spark.createDataFrame([(1, "x "), (2, "bad")], "id int, text string"), lambda t: '{"paper":{"doi":"d"},"samples":[{"sample_label":"s"},{"sample_label":"r"}]}' if t == "x" else "no")
    assert rows(extraction.flattened(out).select("id", "doi", "sample_label")) == [(1, "d", "r"), (1, "d", "s"), (2, None, None)]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    ev = spark.read.parquet(f"{DATA}/events.parquet")
    inbox, seen = str(tmp_path / "in"), {}
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(inbox)

    def sink(batch, _):
        seen.update({r.user_id: (r.attempts, r.failures) for r in batch.collect()})

    for part in (None, "event_id % 2 = 1"):
        if part:
            ev.where(part).coalesce(1).write.mode("append").parquet(inbox)
        streaming.run_available(streaming.folded(streaming.stream(spark, inbox, ev.schema)), sink, str(tmp_path / "cp"), "update")
    want = {r.user_id: (r.n, r.f) for r in ev.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("f")).collect()}
    assert seen == want
    assert streaming.window_counts(streaming.stream(spark, inbox, ev.schema)).isStreaming
