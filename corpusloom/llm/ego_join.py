"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. Vectors are sorted by grid cells of that side on the leading principal dimensions;
the sequence is dealt into segments, and each two segments whose boxes are near are joined by one task, which halves both
intervals again and again and skips what its boxes prove to be too far apart. A box spans the leading dimensions and the length of what is
left of a vector beside them; that map never lengthens a distance, so nothing within the threshold is skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, cut, small_batches

COSINE, LEAD = 0.95, 8
#: Vectors of a segment (a task holds two), vectors of an interval that is compared whole, vectors that the axes are fitted on.
SEGMENT, LEAF, SAMPLE = 4096, 128, 4096
#: Within this of the threshold, the cosine is computed again from the vectors as given.
CLOSE = 1e-9


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to `width`."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(flat) == width * len(column):
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    ends = np.cumsum(sizes)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def axes(sample: np.ndarray, lead: int) -> np.ndarray:
    """Leading principal directions (columns, orthonormal) of unit vectors."""
    width = sample.shape[1]
    centred = sample - sample.mean(axis=0) if len(sample) else sample
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, : min(lead, width)]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def shadow(units: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Coordinates on the directions, then the length of the rest."""
    lead = units @ directions
    rest = np.sqrt(np.maximum(0, (units * units).sum(axis=1) - (lead * lead).sum(axis=1)))
    return np.hstack([lead, rest[:, None]])


class IntervalJoin:
    """Links between the intervals of one or two segments: weighted degrees, and a forest of the links."""

    def __init__(self, raw, sizes, weights, directions, cosine, leaf=LEAF):
        self.raw, self.sizes, self.weights, self.cosine, self.leaf = raw, sizes, weights, cosine, leaf
        self.units = unit(raw)
        self.shadow = shadow(self.units, directions)
        self.eps2 = 2 - 2 * cosine + 1e-9
        self.degree = np.zeros(len(raw), np.int64)
        self.up = np.arange(len(raw))
        self.leaves = self.skipped = 0

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def far(self, a: tuple[int, int], b: tuple[int, int]) -> bool:
        x, y = self.shadow[a[0] : a[1]], self.shadow[b[0] : b[1]]
        gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
        return float(gap @ gap) > self.eps2

    def join(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        """All links between two intervals (or within one, if they are the same)."""
        if a[0] >= a[1] or b[0] >= b[1]:
            return
        if a != b and self.far(a, b):
            self.skipped += 1
            return
        if max(a[1] - a[0], b[1] - b[0]) <= self.leaf:
            self.compare(a, b)
            return
        if a == b:
            m = (a[0] + a[1]) // 2
            self.join((a[0], m), (a[0], m))
            self.join((a[0], m), (m, a[1]))
            self.join((m, a[1]), (m, a[1]))
        elif a[1] - a[0] >= b[1] - b[0]:
            m = (a[0] + a[1]) // 2
            self.join((a[0], m), b)
            self.join((m, a[1]), b)
        else:
            m = (b[0] + b[1]) // 2
            self.join(a, (b[0], m))
            self.join(a, (m, b[1]))

    def compare(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        self.leaves += 1
        found = self.units[a[0] : a[1]] @ self.units[b[0] : b[1]].T
        near = found >= self.cosine
        for i, j in np.argwhere(np.abs(found - self.cosine) < CLOSE):
            x, y = self.raw[a[0] + i], self.raw[b[0] + j]
            near[i, j] = float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= self.cosine
        near &= self.sizes[a[0] : a[1], None] == self.sizes[None, b[0] : b[1]]
        if a == b:
            np.fill_diagonal(near, False)
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            return
        self.degree[a[0] : a[1]] += near @ self.weights[b[0] : b[1]]
        if a != b:
            self.degree[b[0] : b[1]] += self.weights[a[0] : a[1]] @ near
        for i in rows.tolist():
            tops = {self.root(a[0] + i)}
            labels = np.unique(self.up[b[0] + np.flatnonzero(near[i])])
            tops.update(self.root(int(x)) for x in labels)
            self.up[list(tops)] = min(tops)


def _grid(directions: np.ndarray, width: int, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead = unit(matrix(batch.column(0), width)) @ directions
                cells = np.clip(np.floor(lead / eps).astype(np.int64) + 8, 0, 15)
                key = np.zeros(len(cells), np.int64)
                for c in cells.T:
                    key = key * 16 + c
                yield pa.record_batch([*batch.columns, pa.array(key)], [*batch.schema.names, "cell"])

    return run


def _boxes(directions: np.ndarray, width: int):
    """Bounds of the vectors of each segment in a batch: they are merged afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seen = batch.column(1).to_numpy(zero_copy_only=False)
                flat = shadow(unit(matrix(batch.column(0), width)), directions)
                for s in np.unique(seen):
                    part = flat[seen == s]
                    yield pa.record_batch([pa.array([s], pa.int32()), pa.array([part.min(axis=0).tolist()]), pa.array([part.max(axis=0).tolist()])], ["segment", "low", "high"])

    return run


def _join(directions: np.ndarray, width: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            segment = table.column("segment").to_numpy()
            order = np.argsort(segment, kind="stable")
            reps = table.column("rep").to_numpy()[order]
            raw = matrix(table.column("embedding").combine_chunks(), width)[order]
            sizes = np.diff(table.column("embedding").combine_chunks().offsets.to_numpy())[order]
            work = IntervalJoin(raw, sizes, table.column("n").to_numpy()[order], directions, cosine)
            cut_at = int((segment == segment.min()).sum())
            n = len(reps)
            if cut_at == n:
                work.join((0, n), (0, n))
            else:
                work.join((0, cut_at), (cut_at, n))
            has = np.flatnonzero(work.degree)
            tops = np.asarray([work.root(i) for i in has.tolist()], np.int64)
            tree = has != tops
            a = np.concatenate([reps[has], reps[has[tree]]])
            b = np.concatenate([np.zeros(len(has), np.int64), reps[tops[tree]]])
            links = np.concatenate([work.degree[has], np.zeros(int(tree.sum()), np.int64)])
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "n"])

        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy().astype(np.int64) * (1 << 31) + batch.column(1).to_numpy()
            change = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for s, e in zip(change, change[1:], strict=False):
                if now is not None and keys[s] != now:
                    yield solve(pa.Table.from_batches(held))
                    held = []
                now = keys[s]
                held.append(batch.slice(s, e - s))
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def embedding_links(vectors: DataFrame, *, cosine: float = COSINE, lead: int = LEAD, segment: int = SEGMENT, sample: int = SAMPLE) -> DataFrame:
    """Per row vec_id, n_links (other rows with a cosine of at least `cosine`), component_id and kept.

    Null vectors, and vectors that are empty, zero, or hold null or non-finite components, have no links and are components
    of their own; so are rows without vec_id (component null, kept). Vectors of different lengths aren't linked. Repeated rows are
    vectors of their own, linked to each other. No rows give no rows; only vec_id and embedding are read, and copies of a vector are one class,
    so a large group of copies costs one row. The axes are fitted on at most `sample` classes, in the order of a hash; they
    decide what can be skipped, not what is found.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    fit = rows.where("vec_id is not null").where(F.coalesce(good, F.lit(False)))
    # rows may share a vec_id, so a class has a number of its own, which the checkpoint keeps
    classes = cut(fit.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("rep", F.monotonically_increasing_id()))
    seen = classes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    total, width = seen["n"], seen["width"] or 1
    taken = classes.select("embedding", F.xxhash64(F.lit(1), "rep").alias("h")).orderBy("h").limit(sample).toArrow()
    directions = axes(unit(matrix(taken.column("embedding").combine_chunks(), width)) if total else np.zeros((0, width)), lead)
    eps = math.sqrt(2 - 2 * cosine)

    # the sequence, dealt into segments in its order; small tables get more of them, so that there is work for all
    segment = min(segment, max(LEAF * 4, total // 16))
    count = max(1, -(-total // segment))
    graded = classes.select("embedding", "rep", "n").mapInArrow(_grid(directions, width, eps), "embedding array<double>, rep long, n long, cell long")
    dealt = cut(graded.repartitionByRange(count, "cell", "rep").select("embedding", "rep", "n", "cell", F.spark_partition_id().alias("part")))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")  # over a row a partition
    placed = dealt.join(sizes.select("part", F.floor(before / segment).cast("int").alias("segment")), "part").select("embedding", "segment", "rep", "n")

    # segments whose boxes are near; they meet on the cells of the first dimension
    dims = directions.shape[1] + 1
    boxes = placed.select("embedding", "segment").mapInArrow(_boxes(directions, width), "segment int, low array<double>, high array<double>")
    bound = boxes.groupBy("segment").agg(*(F.min(F.col("low")[i]).alias(f"l{i}") for i in range(dims)), *(F.max(F.col("high")[i]).alias(f"h{i}") for i in range(dims)))
    cell = lambda c: F.floor(F.col(c) / eps)
    one = bound.select("*", F.explode(F.sequence(cell("l0"), cell("h0"))).alias("at"))
    two = bound.select(*(F.col(c).alias(f"o{c}") for c in bound.columns), F.explode(F.sequence(cell("l0") - 1, cell("h0") + 1)).alias("at"))
    gap = sum((F.greatest(F.lit(0.0), F.col(f"l{i}") - F.col(f"oh{i}"), F.col(f"ol{i}") - F.col(f"h{i}")) ** 2 for i in range(dims)), F.lit(0.0))
    pairs = one.join(two, "at").where(F.col("segment") <= F.col("osegment")).where((F.col("segment") == F.col("osegment")) | (gap <= eps * eps + 1e-9)).select(F.col("segment").alias("low"), F.col("osegment").alias("high")).distinct()
    sides = pairs.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("segment"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = placed.join(sides, "segment").select("low", "high", "segment", "rep", "n", F.col("embedding").cast("array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>").alias("embedding"))
    found = cut(work.repartition(tasks, "low", "high").sortWithinPartitions("low", "high", "segment").mapInArrow(_join(directions, width, cosine), "a long, b long, n long"))

    degrees = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    linked = components(found.where("n = 0").select("a", "b"))
    known = classes.join(degrees, "rep", "left").join(linked, F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("component", "rep"))
    named = known.groupBy("group").agg(F.min("least").alias("_component"))
    known = known.join(named, "group").select(F.col("embedding").alias("_vector"), (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("_links"), "_component")
    linked = fit.join(known, F.col("embedding") == F.col("_vector")).select("vec_id", "_links", "_component")
    # all other rows, which link with nothing
    fits = F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))
    out = linked.union(rows.where(~fits).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select("vec_id", F.col("_links").cast("long").alias("n_links"), F.col("_component").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("_component"), F.lit(True)).alias("kept"))


def op7_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
