import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators import buckets
from corpusloom.plans import queue
from corpusloom.streaming import states

START = datetime(2024, 1, 1, tzinfo=UTC)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def attempts(spark, n, seed):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        ok = rng.choice([True, False, False, None])
        made.append((rng.choice(["p1", "p2", "p3", "p4", "hot", "hot", "hot", None]), rng.choice(["wiley", "arxiv", None]), ok, None if ok else f"E{rng.randrange(4)}", "/p" if ok else None, "pdf", rng.choice([None, START + timedelta(minutes=rng.randrange(40))]), i))
    return spark.createDataFrame(made, queue.ATTEMPT)


def test_bounded_fold_equals_the_whole_one(spark):
    log = attempts(spark, 150, 1).where("paper is not null").withColumn("ok", F.coalesce("ok", F.lit(False))).withColumn("at", F.coalesce("at", F.lit(START)))
    whole = queue.fold(log)
    bounded = queue.bounded_columns(queue.fold_bounded(log, keep=1000))
    assert rows(bounded) == rows(whole.select(*bounded.columns))


@pytest.mark.parametrize("keep", [3, 20])
def test_states_merge_in_any_grouping(spark, keep):
    log = attempts(spark, 300, keep).cache()
    want = rows(queue.fold_bounded(log, keep))
    parts = [queue.fold_bounded(log.where(F.col("seq") % 4 == i), keep) for i in range(4)]
    assert rows(queue.merged_folds(*parts, keep=keep)) == want
    assert rows(queue.merged_folds(queue.merged_folds(parts[3], parts[1], keep=keep), queue.merged_folds(parts[0], parts[2], keep=keep), keep=keep)) == want
    log.unpersist()


def test_paper_of_a_million_attempts(spark):
    n = 1_000_000
    i = F.col("id")
    log = spark.range(n).select(F.concat(F.lit("hot"), (i % 1).cast("string")).alias("paper"), F.lit("wiley").alias("source"), (i % 10 == 0).alias("ok"), F.concat(F.lit("E"), i.cast("string")).alias("error"), F.lit("/p").alias("path"), F.lit("pdf").alias("format"), F.timestamp_seconds(i).alias("at"), i.alias("seq"))
    state = queue.fold_bounded(log, keep=5)
    assert "WindowGroupLimit" in state._jdf.queryExecution().executedPlan().toString()
    r = state.first()
    assert (r.attempts, r.failures, r.last.seq, r.success.seq, [x.seq for x in r.recent]) == (n, n - n // 10, n - 1, n - 10, [n - 5, n - 4, n - 3, n - 2, n - 1])
    by_steps = states.advanced(None, (row(x) for x in range(2000)), 5)
    assert by_steps[:2] == (2000, 1800) and [x[1] for x in by_steps[4]] == [1995, 1996, 1997, 1998, 1999]


def row(x):
    return Row(paper="hot", source="wiley", ok=x % 10 == 0, error=f"E{x}", path="/p", format="pdf", at=START + timedelta(seconds=x), seq=x)


def test_stream_of_attempts_equals_the_batch(spark, tmp_path):
    log = attempts(spark, 240, 5)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    seen = {}
    try:
        for part in range(3):
            log.where(F.col("seq") % 3 == part).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(StructType.fromDDL(queue.ATTEMPT)).parquet(f"{tmp_path}/in")
            sink = lambda batch, _: seen.update({r.paper: r for r in batch.collect()})
            states.folded_stream(stream, 4).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    assert sorted(map(tuple, seen.values()), key=str) == rows(queue.fold_bounded(log, 4))


def test_batches_that_die_are_repeated_without_harm(spark, tmp_path, monkeypatch):
    schema = "doi string, abstract string"
    table = buckets.create(spark.createDataFrame([("a", "kept")], schema), f"file://{tmp_path}/t", ["doi"], 8)
    made = []

    def make(batch):
        made.append(batch.count())
        return batch.withColumn("abstract", F.upper("abstract"))

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        states.enrich_available(stream, table, make, f"{tmp_path}/check", f"file://{tmp_path}/ledger")

    spark.createDataFrame([("a", "new"), ("b", "b")], schema).write.parquet(f"{tmp_path}/in")
    run()
    assert rows(table.read(spark)) == [("a", "kept"), ("b", "B")] and made == [2]
    spark.createDataFrame([("b", "later"), ("c", "c"), (None, "x")], schema).write.mode("append").parquet(f"{tmp_path}/in")

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(states, "touched", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    after = rows(table.read(spark))
    assert after == [("a", "kept"), ("b", "B"), ("c", "C")]
    run()
    assert rows(table.read(spark)) == after and made == [2, 3, 3]
    run()
    assert made == [2, 3, 3]
    states.once(spark, f"file://{tmp_path}/ledger", dies)(None, 1)  # entered, so the sink isn't called
