"""The download queue as an append-only log of attempts; the state of a paper is a fold over its attempts.

Nothing is updated in place, so writers of several sources never contend, and a lost task repeats without harm.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ATTEMPT = "paper string, source string, ok boolean, error string, path string, format string, at timestamp, seq long"


@dataclass(frozen=True)
class Source:
    """What differs between the sources of full text."""

    name: str
    lookup: str
    format: str
    spacing: float
    batch: int = 1


#: Identifier, file format, least seconds between requests, identifiers per request.
SOURCES = {s.name: s for s in (Source("elsevier", "doi", "xml", 0.125), Source("springer_nature", "doi", "xml", 2.0, 20), Source("wiley", "doi", "pdf", 11.0), Source("europepmc", "pmcid", "xml", 0.15), Source("arxiv", "arxiv_id", "pdf", 0.5))}


def fold(attempts: DataFrame) -> DataFrame:
    """State per paper: counts, the ordered sources and failures, and what the last attempt left. Failures stay in the history after a success."""
    at = F.struct("at", "seq")
    log = F.array_sort(F.collect_list(F.struct("at", "seq", "source", "ok", "error")))
    out = attempts.groupBy("paper").agg(
        F.count("*").alias("attempt_count"), F.max_by(F.when(F.col("ok"), "success").otherwise("failed"), at).alias("download_status"), F.max_by("source", at).alias("last_attempted_source"), F.max("at").alias("last_attempted_at"),
        F.max_by("error", at).alias("last_error"), F.max_by("path", F.when(F.col("ok"), at)).alias("fulltext_path"), F.max_by("format", F.when(F.col("ok"), at)).alias("fulltext_format"), F.max_by("source", F.when(F.col("ok"), at)).alias("downloaded_from"), F.max(F.when(F.col("ok"), F.col("at"))).alias("downloaded_at"), log.alias("log"),
    )
    failed = F.filter("log", lambda a: ~a["ok"])
    stamped = F.transform(failed, lambda a, i: F.struct(a["source"].alias("source"), F.lit("failed").alias("status"), a["error"].alias("error"), (i + 1).cast("int").alias("attempt"), F.date_format(a["at"], "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")))
    return out.withColumns({
        "attempted_sources": F.to_json(F.transform("log", lambda a: a["source"])), "failure_history": F.to_json(stamped), "failures": F.size(failed).cast("bigint"),
        "last_error": F.when(F.col("download_status") == "failed", F.col("last_error")),
    }).drop("log")


#: Failures that a bounded state keeps: the last ones.
KEEP = 20
BOUNDED = (
    "paper string, attempts long, failures long, last struct<at:timestamp,seq:long,source:string,ok:boolean,error:string>, "
    "success struct<at:timestamp,seq:long,source:string,path:string,format:string>, recent array<struct<at:timestamp,seq:long,source:string,error:string>>"
)


def fold_bounded(attempts: DataFrame, keep: int = KEEP) -> DataFrame:
    """BOUNDED per paper: what fold() tells but for the whole list of sources, with the last `keep` failures.

    Everything is a sum, a greatest or the last few of a group, so a paper takes the same little memory however often it was tried. A null `ok` is a failure; attempts
    without a paper are left out.
    """
    rows = attempts.where("paper is not null").withColumn("ok", F.coalesce("ok", F.lit(False)))
    sums = rows.groupBy("paper").agg(
        F.count("*").alias("attempts"), F.count_if(~F.col("ok")).alias("failures"), F.max(F.struct("at", "seq", "source", "ok", "error")).alias("last"), F.max(F.when(F.col("ok"), F.struct("at", "seq", "source", "path", "format"))).alias("success")
    )
    each = F.struct("at", "seq", "source", "error")
    late = Window.partitionBy("paper").orderBy(*(F.desc(c) for c in ("at", "seq", "source", "error")))
    last = rows.where(~F.col("ok")).withColumn("_n", F.row_number().over(late)).where(F.col("_n") <= keep).groupBy("paper").agg(F.array_sort(F.collect_list(each)).alias("recent"))
    return sums.join(last, "paper", "left").withColumn("recent", F.coalesce("recent", F.array().cast(BOUNDED.partition("recent ")[2])))


def merged_folds(*states: DataFrame, keep: int = KEEP) -> DataFrame:
    """BOUNDED of all attempts, from those of parts of them in any order and grouping."""
    every = reduce(DataFrame.unionByName, states)
    late = F.array_sort(F.flatten(F.collect_list("recent")))
    return every.groupBy("paper").agg(F.sum("attempts").alias("attempts"), F.sum("failures").alias("failures"), F.max("last").alias("last"), F.max("success").alias("success"), late.alias("recent")).withColumn(
        "recent", F.slice("recent", F.greatest(F.size("recent") - keep + 1, F.lit(1)), F.lit(keep))
    )


def bounded_columns(state: DataFrame) -> DataFrame:
    """The columns of fold() that a bounded state can tell; failures are numbered as if all were there."""
    failed, before = ~F.col("last.ok"), F.col("failures") - F.size("recent")
    stamped = F.transform("recent", lambda a, i: F.struct(a["source"].alias("source"), F.lit("failed").alias("status"), a["error"].alias("error"), (before + i + 1).cast("int").alias("attempt"), F.date_format(a["at"], "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")))
    return state.select(
        "paper", F.col("attempts").alias("attempt_count"), F.when(failed, "failed").otherwise("success").alias("download_status"), F.col("last.source").alias("last_attempted_source"), F.col("last.at").alias("last_attempted_at"), F.when(failed, F.col("last.error")).alias("last_error"),
        F.col("success.path").alias("fulltext_path"), F.col("success.format").alias("fulltext_format"), F.col("success.source").alias("downloaded_from"), F.col("success.at").alias("downloaded_at"), F.to_json(stamped).alias("failure_history"), "failures",
    )


STATE = ("attempt_count", "download_status", "last_attempted_source", "last_attempted_at", "last_error", "fulltext_path", "fulltext_format", "downloaded_from", "downloaded_at", "attempted_sources", "failure_history")


def applied(papers: DataFrame, state: DataFrame) -> DataFrame:
    """The registry with its papers' states; papers without attempts stay as they are."""
    named = state.select(F.col("paper").alias("_paper"), *(F.col(c).alias(f"_{c}") for c in STATE))
    joined = papers.join(named, papers["paper_uid"] == F.col("_paper"), "left")
    values = {c: F.when(F.col("_paper").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c) if c in papers.columns else F.lit(None)) for c in STATE}
    return joined.withColumns(values).drop("_paper", *(f"_{c}" for c in STATE))


def reconciled(pending: DataFrame, files: DataFrame) -> DataFrame:
    """Attempts for pending papers that have a file already: files(paper, path, format, ok, reason, at) were checked before."""
    return pending.join(files, pending["paper_uid"] == files["paper"]).select("paper", F.col("canonical_source").alias("source"), "ok", F.when(~F.col("ok"), F.col("reason")).alias("error"), "path", "format", "at", F.lit(0).cast("long").alias("seq"))


def retried(df: DataFrame, column: str, status: str) -> DataFrame:
    """Rows whose `column` has the error status are open again."""
    return df.withColumn(column, F.when(F.col(column) != status, F.col(column)))


def retry_counts(df: DataFrame, column: str, status: str) -> DataFrame:
    """(moment, count) of rows with the error status, before retried() and after."""
    bad = lambda d, when: d.agg(F.count_if(F.coalesce(F.col(column) == status, F.lit(False))).alias("count")).select(F.lit(when).alias("moment"), "count")
    return bad(df, "before").union(bad(retried(df, column, status), "after"))


def audit(state: DataFrame) -> DataFrame:
    """(metric, count) of the queue: more than one attempt, failures that differ from attempts, sources tried."""
    metrics = {"papers": F.lit(True), "retried": F.col("attempt_count") > 1, "failed": F.col("download_status") == "failed", "all_attempts_failed": F.col("failures") == F.col("attempt_count")}
    return state.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in metrics.items())).unpivot([], list(metrics), "metric", "count")
