"""The queue's bounded fold as the state of a stream, and sinks that take each batch once."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators import buckets
from ..plans.queue import BOUNDED, KEEP
from ..session import listed, touched

#: Times are microseconds inside the state, as workers hand timestamps with and without a zone.
LONGS = BOUNDED.replace("timestamp", "long")
VALUE = LONGS.partition(", ")[2]
OUT, LAST, SUCCESS, FAILURE = (Row(*names.split()) for names in ("paper attempts failures last success recent", "at seq source ok error", "at seq source path format", "at seq source error"))


def _order(*values) -> tuple:
    """Nulls first, as Spark compares structs."""
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def advanced(state: tuple | None, rows: Iterable[Row], keep: int = KEEP) -> tuple:
    """The state (attempts, failures, last, success, recent) after more attempts, one at a time."""
    attempts, failures, last, success, recent = state or (0, 0, None, None, [])
    held = [(_order(*r), tuple(r)) for r in recent]
    heapq.heapify(held)
    for r in rows:
        ok = bool(r.ok)
        attempts, failures = attempts + 1, failures + (not ok)
        now = (r.at, r.seq, r.source, ok, r.error)
        last = now if last is None or _order(*now) > _order(*last) else tuple(last)
        if ok:
            now = (r.at, r.seq, r.source, r.path, r.format)
            success = now if success is None or _order(*now) > _order(*success) else tuple(success)
        else:
            now = (r.at, r.seq, r.source, r.error)
            (heapq.heappushpop if len(held) >= keep else heapq.heappush)(held, (_order(*now), now))
    return attempts, failures, last and tuple(last), success and tuple(success), [x for _, x in sorted(held)]


class FoldAttempts(StatefulProcessor):
    """One value a paper, which is as large after a million attempts as after a few; attempts are taken from an iterator."""

    def __init__(self, keep: int = KEEP):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("fold", VALUE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        state = advanced(tuple(self.value.get()) if self.value.exists() else None, rows, self.keep)
        self.value.update(state)
        attempts, failures, last, success, recent = state
        yield OUT(*key, attempts, failures, last and LAST(*last), success and SUCCESS(*success), [FAILURE(*x) for x in recent])

    def close(self) -> None:
        pass


def folded_stream(attempts: DataFrame, keep: int = KEEP) -> DataFrame:
    """BOUNDED of every paper that a batch of a stream of attempts has touched (output mode update). Needs the RocksDB state store."""
    timed = attempts.where("paper is not null").withColumn("at", F.unix_micros("at"))
    out = timed.groupBy("paper").transformWithState(FoldAttempts(keep), StructType.fromDDL(LONGS), "Update", "None")
    stamp = lambda c: F.when(c.isNotNull(), c.withField("at", F.timestamp_micros(c["at"])))
    return out.withColumns({"last": stamp(F.col("last")), "success": stamp(F.col("success")), "recent": F.transform("recent", stamp)})


def once(spark: SparkSession, ledger: str, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`sink`, called for batches that the ledger (a folder of empty files) doesn't have; each is entered after the sink has returned.

    A batch that died between the two is given to the sink again, so the sink must bear that; one that is entered never is.
    """

    def run(batch: DataFrame, number: int) -> None:
        entry = f"batch-{number:012d}"
        if entry not in listed(spark, ledger):
            sink(batch, number)
            touched(spark, f"{ledger}/{entry}")

    return run


def enrich_available(source: DataFrame, table: buckets.BucketTable, make: Callable[[DataFrame], DataFrame], checkpoint: str, ledger: str) -> None:
    """Add make(new rows) of a stream to a bucketed table and stop when all that has arrived is in.

    Keys that the table has stay as they are, so a batch that is repeated adds nothing.
    """
    sink = once(source.sparkSession, ledger, lambda batch, _: buckets.insert_ignore(table, make(batch)) and None)
    source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
