"""Harvests that go on where they stopped: state of each query or date bucket, saved before a failure is raised."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.pages import ResumablePages

STATE = "query string, cursor string, pages long, records long, finished boolean, error string, run long"
#: Ids of one lookup, at most.
LOOKUP = 25


def state(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each query; none before the first run."""
    try:
        rows = spark.read.schema(STATE).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], STATE)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("run")))).where("_r = 1").drop("_r")


def harvest(spark: SparkSession, queries: Iterable[str], fetch: str, pages: str, states: str, *, start: str = "*", max_pages: int = 0) -> DataFrame:
    """Read what `queries` have left, append the pages and then the state, and give the new state; raise the first failure after that.

    Finished queries are skipped, others go on from their cursor, `max_pages` of each at most. The state has a row a query; pages are written by
    executors. A run that dies between the two writes repeats pages: readers take the last run of a (query, cursor).
    """
    known = {r["query"]: r for r in state(spark, states).collect()}
    todo = {q: known[q]["cursor"] if q in known else start for q in dict.fromkeys(queries) if q not in known or not known[q]["finished"]}
    run = 1 + max((r["run"] for r in known.values()), default=0)
    if todo:
        spark.dataSource.register(ResumablePages)
        read = spark.read.format("resumablepages").option("fetch", fetch).option("resume", json.dumps(todo)).option("maxPages", str(max_pages)).load()
        at = f"{pages}/run={run}"
        read.write.mode("overwrite").parquet(at)
        last = spark.read.parquet(at).groupBy("query").agg(F.max_by(F.struct("next", "finished", "error"), "page").alias("l"), F.count_distinct(F.when(F.col("error").isNull(), F.col("cursor"))).alias("pages"), F.count("record").alias("records"))
        old = spark.createDataFrame([tuple(r) for r in known.values()], STATE).select("query", F.col("pages").alias("p"), F.col("records").alias("r"))
        new = last.join(old, "query", "left").select("query", F.col("l.next").alias("cursor"), (F.col("pages") + F.coalesce("p", F.lit(0))).alias("pages"), (F.col("records") + F.coalesce("r", F.lit(0))).alias("records"), "l.finished", "l.error", F.lit(run).cast("long").alias("run"))
        new.write.mode("append").parquet(states)
    now = state(spark, states)
    if todo and (failed := now.where(F.col("error").isNotNull() & (F.col("run") == run)).orderBy("query").first()):
        raise RuntimeError(f"{failed['query']}: {failed['error']}")
    return now


def bucket_queries(buckets: Iterable[tuple[datetime, datetime, int]]) -> list[str]:
    """`submittedDate:[a TO b]` of each bucket: the queries of a harvest by date."""
    return [f"submittedDate:[{a:%Y%m%d%H%M} TO {b:%Y%m%d%H%M}]" for a, b, _ in buckets]


def looked_up(ids: DataFrame, client: Callable[[str], dict[str, str]], column: str = "eid", size: int = LOOKUP) -> DataFrame:
    """Every id with its record: `EID(a) OR EID(b)` of at most `size` ids is asked at once, and answers are matched back by id.

    outcome: FOUND, MISSING (no answer for this id) or FAILED (the lookup failed; record holds why). Null ids are MISSING and not asked for.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), size):
                some = frame[column].iloc[i : i + size]
                asked = list(dict.fromkeys(x for x in some if x is not None))
                try:
                    given, why = client(" OR ".join(f"EID({x})" for x in asked)) if asked else {}, None
                except Exception as e:  # one lookup fails, the others go on
                    given, why = {}, f"{type(e).__name__}: {e}"
                yield pd.DataFrame({column: some, "record": [given.get(x, why if x is not None else None) for x in some], "outcome": ["MISSING" if x is None else "FAILED" if why else "FOUND" if x in given else "MISSING" for x in some]})

    return ids.select(F.col(column).cast("string").alias(column)).mapInPandas(run, f"{column} string, record string, outcome string")
