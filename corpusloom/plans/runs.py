"""Runs over a dump that count what they do in the pass that writes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import contains_ci
from ..sources.dumps import BAD


def keyword_run(records: DataFrame, abstracts: DataFrame, word: str, path: str, key: str = "corpusid", titles: tuple[str, ...] = ("title",), mode: str = "errorifexists") -> dict[str, int]:
    """Write the records that have an abstract and hold the word in a title or in it, as gzip JSON lines with the abstract, and count the run.

    lines; bad (malformed, kept by PERMISSIVE, or without key); papers (the others); unmatched (without abstract), matched; passed and failed (of the matched). One job reads,
    joins, counts and writes. The counts are taken behind the last exchange, so that a task that is repeated isn't counted twice; bad lines go through the join for that,
    spread over all tasks. `abstracts` has one row a key. A null abstract is there but empty. Blank lines aren't lines.
    """
    flawed = F.col(BAD).isNotNull() if BAD in records.columns else F.lit(False)
    rows = records.withColumns({"_flawed": flawed | F.col(key).isNull(), "_salt": F.when(F.col(key).isNull(), F.xxhash64(F.col(BAD) if BAD in records.columns else F.lit(0), F.monotonically_increasing_id())).otherwise(0)})
    known = abstracts.select(F.col(key), F.col("abstract"), F.lit(True).alias("_known"), F.lit(0).cast("long").alias("_salt"))
    joined = rows.join(known, [key, "_salt"], "left")
    good = ~F.col("_flawed")
    matched = good & F.coalesce("_known", F.lit(False))
    hit = reduce(or_, (contains_ci(F.col(c), word) for c in (*titles, "abstract")))
    seen = Observation()
    counted = joined.withColumns({"_matched": matched, "_hit": matched & hit}).observe(
        seen, F.count("*").alias("lines"), F.count_if("_flawed").alias("bad"), F.count_if(good).alias("papers"), F.count_if(good & ~F.col("_matched")).alias("unmatched"), F.count_if("_matched").alias("matched"),
        F.count_if("_hit").alias("passed"), F.count_if(F.col("_matched") & ~F.col("_hit")).alias("failed"),
    )
    counted.where("_hit").drop("_flawed", "_salt", "_known", "_matched", "_hit", BAD).write.mode(mode).option("compression", "gzip").json(path)
    return {k: seen.get[k] for k in ("lines", "bad", "papers", "unmatched", "matched", "passed", "failed")}
