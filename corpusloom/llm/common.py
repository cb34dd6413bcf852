"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: ASCII white space between words; `bytes.split()` cuts at exactly these.
SPACE = "\x20\x09-\x0d"
WORD = re.compile(rf"[^{SPACE}]+")
#: Rows and bytes of a batch that is handed to Python, so that long texts don't fill a worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Links that one task settles; links of a node that are not sent to one task.
FEW_LINKS, HOT_NODE = 1 << 18, 1 << 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session (they only ever get smaller)."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = re.fullmatch(r"(\d+)b?", str(spark.conf.get(name)))
        if now is None or not 0 < int(now[1]) <= most:
            spark.conf.set(name, str(most))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """One call of `fn` for each Arrow batch of `df`, without state between batches."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A temporary one stands in for it on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set, and executors share no other folder")
        base = f"file://{tempfile.gettempdir()}/corpusloom-shared"
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that shared_dir() named, in whatever store it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: what has been computed is kept in the shared checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that is sorted and merged. Adaptive execution would else broadcast a side by its size as it was shuffled, which is packed: sides that
    grow with the input and lie below its threshold fill the driver's memory."""
    return df.hint("merge")


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def utf8(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row begins (one more than rows); null as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    col = col.cast(pa.large_string()).fill_null("") if col.null_count else col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base odd)."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        got = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)]) for b in (base, inverse))
        if len(_POWERS) < 8 and size <= 1 << 24:
            _POWERS[base] = got
    return got[0][:n], got[1][:n]


def rolling(values: np.ndarray, k: int, base: int) -> np.ndarray:
    """64-bit hash of each k consecutive values (mixed polynomial modulo 2**64)."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(base, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values, by doubling."""
    if len(x) < w:
        return x[:0]
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the half-open spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _forest(most: int | None = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) to as few links with the same components; memory is bounded by `most` nodes, or by the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (p := up.get(top, top)) != top:
                top = p
            while x != top:
                up[x], x = top, up.get(x, x)
            return top

        def flush() -> Iterator[pa.RecordBatch]:
            pairs = [(r, x) for x in list(up) if (r := root(x)) != x]
            up.clear()
            for i in range(0, len(pairs), 1 << 16):
                a, b = zip(*pairs[i : i + (1 << 16)], strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    low, high = (a, b) if a < b else (b, a)
                    up[high] = low
                    up.setdefault(low, low)
            if most is not None and len(up) > most:
                yield from flush()
        yield from flush()

    return run


def _with_least(links: DataFrame, by: str, value: str, hot: int) -> DataFrame:
    """Each link with `m`, the least `value` of those with the same `by`. Groups of over `hot` links, of which there are few, are joined where they lie."""
    least = links.groupBy(F.col(by).alias("u")).agg(F.min(value).alias("m"), F.count("*").alias("n"))
    few = links.join(shuffled(least.where(F.col("n") <= hot)), F.col(by) == F.col("u"))
    return few.union(links.join(F.broadcast(least.where(F.col("n") > hot)), F.col(by) == F.col("u")))  # 2 * links / hot rows at most


def components(edges: DataFrame, few: int = FEW_LINKS, hot: int = HOT_NODE) -> DataFrame:
    """node, component (the least node reachable) for every node of the links `edges(a, b)`.

    Each task first reduces its links to a forest. If at most `few` links are left, one task settles them; else large-star and small-star
    steps alternate until the links are stars. Links move between tasks by node only, those of a node with many stay where they are, and nothing but
    three numbers a round goes to the driver. Null ends are dropped, loops and repeats change nothing; no links give no rows.
    """
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    now = cut(links.mapInArrow(_forest(), "a long, b long").distinct())
    left = now.count()
    if left <= few:
        now = cut(now.coalesce(1).mapInArrow(_forest(None), "a long, b long")) if left else now
    before = None
    while left > few:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.sum(F.col("a").cast("decimal(38,0)")).alias("s")).first()
        if seen == before:
            break
        before = seen
        large = _with_least(now.union(now.select("b", "a")), "a", "b", hot).where("b > a").select(F.least("a", "m").alias("a"), "b").where("a <> b").distinct()
        small = _with_least(large, "b", "a", hot)
        now = cut(small.select(F.col("m").alias("x"), F.col("a").alias("y")).union(small.select("m", "b")).where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots.distinct())
