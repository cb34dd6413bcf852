"""Changes and runs that write tables and read them again, in the shared folder, and checks of a queue's registry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert as C
from ..functions import text as T
from ..operators import buckets, filters, joins
from ..plans import constraints, quality, queue, runs, statistics
from ..session import scratch
from ..sources import dumps
from .records import attempts
from .staging import papers, read, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, staged: bool = False):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = sql(oracle) if staged else oracle
        return fn

    return register


@query(
    "SELECT doc_id, CASE WHEN d.doc_id IS NULL OR l.toxic = 1 THEN 'flagged' ELSE d.source END AS source, CASE WHEN l.toxic = 1 THEN l.quality WHEN l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL THEN coalesce(l.quality, -1) ELSE -1 END AS grade FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT coalesce(l.toxic = 0 AND l.quality = 0, false)"
)
def bucket_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in buckets: toxic ones replaced, grades filled in where they lacked, bad ones that aren't toxic deleted."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.lit(None).cast("string").alias("grade"))
    labels = read(spark, sf_dir, "labels")
    table = buckets.create(docs, scratch(spark, "bucket-changes"), ["doc_id"], 32)
    buckets.upsert(table, labels.where("toxic = 1").select("doc_id", F.lit("flagged").alias("source"), F.col("quality").cast("string").alias("grade")), "doc_id")
    buckets.fill_missing(table, labels.select("doc_id", F.col("quality").cast("string").alias("value")), "grade")
    buckets.delete(table, labels.where("toxic = 0 and quality = 0"))
    return table.read(spark).select("doc_id", "source", F.coalesce(F.col("grade").cast("int"), F.lit(-1)).alias("grade"))


@query("SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)")
def bucketed_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels in equally many buckets by their key, joined where they lie."""
    side = lambda name, *columns: joins.bucketed(read(spark, sf_dir, name).select("doc_id", *columns), f"{name}_{uuid.uuid4().hex}", "doc_id", 16, scratch(spark, f"bucketed-{name}"))
    return side("documents", "source").join(side("labels", "quality", "toxic"), "doc_id")


@query(
    """WITH r AS (SELECT doc_id, lang = 'es' AS broken, lang <> 'es' AND source = 'src3' AS keyless, split_part(text, chr(10), 1) AS title, text, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents),
c AS (SELECT count(*) AS lines, count(*) FILTER (broken OR keyless) AS bad, count(*) FILTER (NOT (broken OR keyless)) AS papers, count(*) FILTER (NOT (broken OR keyless) AND NOT known) AS unmatched,
  count(*) FILTER (NOT (broken OR keyless) AND known) AS matched, count(*) FILTER (NOT (broken OR keyless) AND known AND (contains(lower(title), 'ing') OR contains(lower(text), 'ing'))) AS passed FROM r)
SELECT lines, bad, papers, unmatched, matched, passed, matched - passed AS failed, passed AS written FROM c"""
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of a dump, some cut short and some without key, run against the abstracts of labelled ones: the run's own counts and what it wrote."""
    docs, at = read(spark, sf_dir, "documents"), scratch(spark, "run")
    fields = [F.split_part("text", F.lit("\n"), F.lit(1)).alias("title")]
    line = F.when(F.col("source") == "src3", F.to_json(F.struct(*fields))).otherwise(F.to_json(F.struct(F.col("doc_id").alias("corpusid"), *fields)))
    cut_short = F.when(F.col("lang") == "es", F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    docs.select(cut_short.alias("value")).write.option("compression", "gzip").text(f"{at}/dump")
    known = docs.join(read(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("corpusid"), F.col("text").alias("abstract"))
    found = runs.keyword_run(dumps.jsonl(spark, f"{at}/dump", "corpusid long, title string"), known, "ing", f"{at}/kept")
    written = spark.read.schema("corpusid long").json(f"{at}/kept")
    return written.agg(*(F.lit(n).cast("long").alias(k) for k, n in found.items()), F.count("*").alias("written"))


@query("SELECT staging_id FROM papers WHERE trim(coalesce(abstract, '')) <> '' AND contains(lower(abstract), 'ing')", staged=True)
def keyword_abstract_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keyword_in_filled(papers(spark, sf_dir), "ing", "abstract").select("staging_id")


@query("SELECT lang, count(DISTINCT source) AS sources, array_to_string(list_sort(list(DISTINCT source)), '|') AS names FROM documents GROUP BY lang")
def sources_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct names of each group: few, as they are names of journals or sources."""
    names = F.array_sort(F.collect_set("source"))
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count_distinct("source").alias("sources"), F.array_join(names, "|").alias("names"))


@query(
    """WITH s AS (SELECT user_id, arg_max(event_type, row(ts, event_id)) AS l, count(*) FILTER (event_type = 'error') AS f, count(*) FILTER (event_type <> 'error') AS k FROM events GROUP BY 1), d AS (SELECT * FROM s WHERE l <> 'error')
SELECT unnest(['success_rows', 'missing_path', 'missing_format', 'with_last_error', 'with_history']) AS metric, unnest([count(*), count(*), 0, 0, count(*) FILTER (f > 0)]) AS count FROM d"""
)
def success_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose last attempt succeeded: what they lack, and how many failed before."""
    return quality.success_audit(queue.fold(attempts(spark, sf_dir)))


@query("WITH s AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS f FROM events GROUP BY 1) SELECT CAST(user_id AS VARCHAR) AS paper, f AS history_length, n AS attempt_count, f = n AS agrees FROM s")
def history_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every attempt is in the history of failures."""
    state = queue.fold(attempts(spark, sf_dir))
    length = C.history_length(F.col("failure_history")).cast("bigint")
    return state.select("paper", length.alias("history_length"), "attempt_count", C.history_agrees(F.col("failure_history"), F.col("attempt_count")).alias("agrees"))


@query("SELECT page_id, starts_with(url, 'https://m.') OR starts_with(url, 'http://m.') AS mobile, len(list_filter([url, CASE WHEN page_id % 3 = 0 THEN url END, html[1:9], ''], lambda x: x IS NOT NULL AND x <> '')) - CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS urls FROM pages")
def url_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = T.candidates(F.col("url"), F.when(F.col("page_id") % 3 == 0, F.col("url")), F.substring("html", 1, 9), F.lit(""))
    return read(spark, sf_dir, "pages").select("page_id", T.starts_with_any(F.col("url"), ("https://m.", "http://m.")).alias("mobile"), F.size(found).cast("bigint").alias("urls"))


@query(
    """, r AS (SELECT *, CASE WHEN lang = 'de' THEN 'unknown' WHEN lang = 'es' THEN NULL ELSE 'pending' END AS download_status, CASE WHEN source <> 'src4' THEN source END AS canonical_source FROM papers),
k AS (SELECT *, row_number() OVER (PARTITION BY identifier_type, identifier_value ORDER BY staging_id) AS i, CASE WHEN doi IS NOT NULL THEN row_number() OVER (PARTITION BY doi ORDER BY staging_id) ELSE 1 END AS d,
  CASE WHEN arxiv_id IS NOT NULL AND canonical_source IS NOT NULL THEN row_number() OVER (PARTITION BY arxiv_id, canonical_source IS NULL ORDER BY staging_id) ELSE 1 END AS a FROM r)
SELECT unnest(['canonical_source_given', 'download_status_given', 'download_status_known', 'identifier_present', 'title_long', 'identifier_unique', 'doi_unique', 'arxiv_id_unique']) AS rule,
  unnest([count(*) FILTER (canonical_source IS NULL), count(*) FILTER (download_status IS NULL), count(*) FILTER (download_status = 'unknown'), 0, count(*) FILTER (length(title) <= 40), count(*) FILTER (i > 1), count(*) FILTER (d > 1), count(*) FILTER (a > 1)]) AS rows FROM k""",
    staged=True,
)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged papers against constraints of the registry: how many rows break each."""
    rows = papers(spark, sf_dir).withColumns({"download_status": F.when(F.col("lang") == "de", "unknown").when(F.col("lang") != "es", "pending"), "canonical_source": F.when(F.col("source") != "src4", F.col("source"))})
    known = {c.name: c for c in constraints.PAPERS}
    rules = [known[n] for n in ("canonical_source_given", "download_status_given", "download_status_known", "identifier_present")]
    rules += [constraints.Check("title_long", "length(title) > 40"), known["identifier_unique"], known["doi_unique"], constraints.Unique("arxiv_id_unique", ("arxiv_id",), "canonical_source IS NOT NULL")]
    return constraints.violations(rows, rules, ["staging_id"])


@query(
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS c FROM events WHERE event_type = 'error'),
h AS (SELECT user_id, string_agg('{"source":"error","status":"failed","error":"E' || event_id % 3 || ' | HTTP 500","attempt":' || i || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}', ',' ORDER BY i) AS t FROM e WHERE i > c - 3 GROUP BY 1),
s AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS f, arg_max(event_type, row(ts, event_id)) AS l, arg_max(event_type, row(ts, event_id)) FILTER (event_type <> 'error') AS g FROM events GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS paper, n AS attempt_count, CASE WHEN l = 'error' THEN 'failed' ELSE 'success' END AS download_status, g AS downloaded_from, f AS failures, '[' || coalesce(t, '') || ']' AS failure_history FROM s LEFT JOIN h USING (user_id)"""
)
def queue_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's state in bounded memory, merged of two halves of the attempts."""
    log = attempts(spark, sf_dir)
    halves = [queue.fold_bounded(log.where((F.col("seq") % 2 == i)), 3) for i in (0, 1)]
    return queue.bounded_columns(queue.merged_folds(*halves, keep=3)).select("paper", "attempt_count", "download_status", "downloaded_from", "failures", "failure_history")


@query(
    ", f AS (SELECT source, lang, min(staging_id) AS first, count(*) AS n FROM papers GROUP BY 1, 2) SELECT source, CAST(sum(n) AS BIGINT) AS row_count, arg_min(lang, first) AS first_title, count(lang) AS title_count, string_agg(lang, '|' ORDER BY first) AS titles FROM f GROUP BY 1",
    staged=True,
)
def first_seen_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of each source in the order in which they first came."""
    return statistics.titles_as_seen(papers(spark, sf_dir), "source", "staging_id", "lang")
