"""Tables that are rebuilt beside the one that is read: versions in folders, and empty marker files of which the last names the version that counts.

A marker is created whole or not at all in any store, and none is ever written over, so a reader that lists them finds the old version or the new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import listed, removed, touched

MARK, VERSION = "live-", "v-"
#: Raises an error to refuse a version; gets it, and the one before or None.
Check = Callable[[DataFrame, DataFrame | None], None]


def _marks(spark: SparkSession, root: str) -> list[str]:
    return [x for x in listed(spark, root) if x.startswith(MARK)]


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that readers see, or None before the first."""
    marks = _marks(spark, root)
    return f"{root}/{marks[-1].partition('=')[2]}" if marks else None


def read(spark: SparkSession, root: str) -> DataFrame:
    """The current version. A frame that was made before a swap goes on reading the version that it was made of."""
    at = current(spark, root)
    if at is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.parquet(at)


def same_rows(new: DataFrame, old: DataFrame | None) -> None:
    """Check: as many rows as before."""
    if old is not None and (before := old.count()) != (after := new.count()):
        raise ValueError(f"{before} rows became {after}")


def publish(df: DataFrame, root: str, *checks: Check) -> str:
    """Write `df` as a new version, check it as it can be read again, and make it current; its folder.

    A version that fails a check, or whose writer dies, stays unseen until recover() removes it. One writer at a time.
    """
    spark = df.sparkSession
    name = f"{VERSION}{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{name}")
    before = current(spark, root)
    old = None if before is None else spark.read.parquet(before)
    for check in checks:
        check(spark.read.parquet(f"{root}/{name}"), old)
    mark(spark, root, name)
    return f"{root}/{name}"


def mark(spark: SparkSession, root: str, name: str) -> None:
    """Make a version current."""
    number = max((int(x[len(MARK) :].partition("=")[0]) for x in _marks(spark, root)), default=0) + 1
    touched(spark, f"{root}/{MARK}{number:012d}={name}")


def recover(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove the versions that no marker names, as broken publications leave them, and those before the current one but for the last `keep`, with their markers."""
    marks = _marks(spark, root)
    old, rest = marks[: max(0, len(marks) - 1 - keep)], {m.partition("=")[2] for m in marks[max(0, len(marks) - 1 - keep) :]}
    gone = [*old, *(x for x in listed(spark, root) if x.startswith(VERSION) and x not in rest)]
    for x in gone:
        removed(spark, f"{root}/{x}")
    return gone
