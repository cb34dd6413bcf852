"""Streaming forms, beyond the batch engine: windowed counts and the queue's fold over a stream of attempts, resumed from a checkpoint."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def window_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day", key: str = "event_type") -> DataFrame:
    """Counts and sums per tumbling window and key; rows later than `late` are dropped by the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, failed, last = state.get if state.exists else (0, 0, None)
    for frame in frames:
        n += len(frame)
        failed += int((frame["event_type"] == "error").sum())
        newest = frame.sort_values(["ts", "event_id"]).iloc[-1]
        at = (newest["ts"].value, int(newest["event_id"]), newest["event_type"])
        last = at if last is None or at[:2] > tuple(last[:2]) else tuple(last)
    state.update((n, failed, last))
    yield pd.DataFrame({"user_id": [key[0]], "attempts": [n], "failures": [failed], "last_type": [last[2]]})


def folded(events: DataFrame) -> DataFrame:
    """Attempts, failures and the last type per user so far: the state is a few numbers a key."""
    return events.groupBy("user_id").applyInPandasWithState(_step, "user_id long, attempts long, failures long, last_type string", "n long, failed long, last struct<ts:long,id:long,type:string>", "update", GroupStateTimeout.NoTimeout)


def run_available(df: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived since the checkpoint and stop; `sink(batch, id)` has to be idempotent by id."""
    df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
