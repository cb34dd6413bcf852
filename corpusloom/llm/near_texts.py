"""Near copies: five-word shingles with a Jaccard similarity of 0.8 or more, found by SimHash and, beyond its radius, by prefixes.

Texts with the same shingles are one class. The covering masks of `simhash_covering` give the pairs of classes whose fingerprints differ in few
bits, and nothing else does. They can't reach all pairs at this similarity, which lie up to 13 bits apart, so an exact set join gives those beyond the radius, and only those:
sort the shingles of every class by how many classes hold them (then by value); two classes with similarity s share one of the first n - ceil(s n) + 1 shingles of
each. Shingles that no other class holds come first in that order, so only classes that are made up of shared shingles have anything to compare. Every
pair of either kind is checked on the whole sets, and none is missed.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simhash_covering
from .common import components, cut, map_batches, rolling, shuffled, small_batches, texts

#: Words of a shingle; the least similarity of near copies as a fraction.
WORDS, NUM, DEN = 5, 4, 5
BASE = 0x9E3779B97F4A7C15
#: Classes that share a shingle and are compared by pairs; more are compared in blocks.
FEW, BLOCK = 16, 512
#: Classes that a task remembers, so as to send their shingles once.
HELD = 1 << 17


def shingles(text: str) -> np.ndarray:
    """Different hashes of the shingles, ascending; a shorter text is one shingle, no words are none."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(w, 1) for w in words], np.uint64, len(words))
    return np.unique(rolling(hashes, min(WORDS, len(words)), BASE))


def _trim() -> None:
    """Give memory that is free in this worker back, as it is kept for later tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def class_of(found: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """The number of a set of shingles, and 64 bits more, which tell sets apart that share a number."""
    return (xxhash.xxh64_intdigest(found.tobytes(), 2) >> (64 - bits)) - (1 << 63), xxhash.xxh64_intdigest(found.tobytes(), 3) - (1 << 63)


def clashes(classes: DataFrame) -> dict[tuple[int, int], int]:
    """New numbers for all but one of the sets that share a number, by number and further bits.

    Of n sets about n * n / 2**65 do, three of ten thousand million, so that few go to the driver and to tasks.
    """
    several = classes.groupBy("cls").agg(F.min("wide").alias("a"), F.max("wide").alias("b")).where("a < b").select("cls", "a")
    found = classes.join(shuffled(several), "cls").where("wide <> a").select("cls", "wide").distinct().collect()
    return {(r["cls"], r["wide"]): xxhash.xxh64_intdigest(f"{r['cls']},{r['wide']}", 4) - (1 << 63) for r in found}


def similar(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of a and b shingles with `both` in common are near copies."""
    return (NUM + DEN) * both >= NUM * (a + b)


def _classes(bits: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t) for t in texts(batch)]
        prints = np.array([simhash_covering.majority(x) if len(x) else 0 for x in found], np.uint64)
        cls, wide = (pa.array(c, pa.int64()) for c in zip(*(class_of(x, bits) for x in found), strict=True))
        return pa.record_batch([*batch.columns[:3], cls, wide, pa.array(prints.view(np.int64))], ["doc_id", "key", "tag", "cls", "wide", "fp"])

    return run


def _moved(moved: dict[tuple[int, int], int]):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
        return pa.record_batch([*batch.columns[:3], pa.array([moved.get(p, p[0]) for p in pairs], pa.int64()), *batch.columns[4:]], batch.schema.names)

    return run


def _deal(buckets: int, bits: int, moved: dict[tuple[int, int], int]):
    """Shingles with their classes, packed for each bucket of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, sets = [], []
            for text in texts(batch):
                found = shingles(text)
                pair = class_of(found, bits)
                c = moved.get(pair, pair[0])
                if len(found) and c not in seen:
                    seen.add(c)
                    ids.append(c)
                    sets.append(found)
            if len(seen) > HELD:
                seen.clear()
            if not ids:
                continue
            n = np.array([len(s) for s in sets], np.int64)
            values, owner, cls = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), n), np.array(ids, np.int64)
            n = n.astype(np.int32)
            to = (values >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(to, kind="stable")
            values, owner, to = values[order], owner[order], to[order]
            at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])).tolist()
            rows = []
            for a, b in zip(at, [*at[1:], len(to)], strict=True):
                own, place = np.unique(owner[a:b], return_inverse=True)
                rows.append((int(to[a]), values[a:b].tobytes(), place.astype(np.uint16).tobytes(), cls[own].tobytes(), n[own].tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), *[pa.binary()] * 4], strict=True)], ["bucket", "values", "place", "cls", "n"])
        _trim()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of more than one class with the number of its classes, from the rows of _deal() of one bucket."""
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> Iterator[pa.RecordBatch]:
        values = np.concatenate([x[0] for x in held])
        order = np.argsort(values)
        v = values[order]
        same = v[1:] == v[:-1]
        order = np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])])
        values = values[order]
        del v, same
        ends = np.cumsum([len(x[0]) for x in held])
        parts = [order[a:b] - s for a, b, s in zip(np.searchsorted(order, ends - [len(x[0]) for x in held]), np.searchsorted(order, ends), ends - [len(x[0]) for x in held], strict=True)]
        cls, n = (np.concatenate([x[k][x[1][at]] for x, at in zip(held, parts, strict=True)]) for k in (2, 3))
        held.clear()
        order = np.lexsort((cls, values))
        values, cls, n = values[order], cls[order], n[order]
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (cls[1:] != cls[:-1])])[: len(values)]
        values, cls, n = values[new], cls[new], n[new]
        if not len(values):
            return
        _, group, count = np.unique(values, return_inverse=True, return_counts=True)
        freq = count[group]
        keep = freq > 1
        made = [values[keep].view(np.int64), cls[keep], n[keep].astype(np.int64), freq[keep].astype(np.int64)]
        for i in range(0, len(made[0]), 1 << 16):
            yield pa.record_batch([pa.array(c[i : i + (1 << 16)]) for c in made], ["shingle", "cls", "n", "freq"])

    for batch in batches:
        for values, place, cls, n in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            held.append((np.frombuffer(values, np.uint64), np.frombuffer(place, np.uint16), np.frombuffer(cls, np.int64), np.frombuffer(n, np.int32)))
    if held:
        yield from out()
    _trim()


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.record_batch([batch.column(0), pa.array([shingles(t).tobytes() for t in texts(batch)], pa.binary())], ["cls", "found"])


def _check(batch: pa.RecordBatch) -> pa.RecordBatch:
    keep = []
    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        keep.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
    return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _forest_of(sets: list[np.ndarray], fps: np.ndarray, close: bool) -> list[tuple[int, int]]:
    """Links that join near copies within the radius of SimHash, or those beyond it; one less than members for each connected part."""
    n = np.array([len(s) for s in sets], np.int64)
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    todo, links = np.ones(len(sets), bool), []
    for s in range(len(sets)):
        if not todo[s]:
            continue
        todo[s] = False
        front = [s]
        while front and todo.any():
            i = front.pop()
            low, high = np.searchsorted(values, sets[i]), np.searchsorted(values, sets[i], "right")
            size = high - low
            places = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            both = np.bincount(owner[places], minlength=len(sets))
            near = np.flatnonzero(todo & similar(both, n, n[i]) & ((np.bitwise_count(fps ^ fps[i]) <= simhash_covering.RADIUS) == close))
            todo[near] = False
            links += [(i, j) for j in near.tolist()]
            front += near.tolist()
    return links


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each two blocks, from rows (close, part, low, high, cls, fp, found) sorted by the first four."""
    at, ids, fps, sets = None, [], [], []

    def out() -> Iterator[pa.RecordBatch]:
        if len(ids) > 1 and (links := _forest_of(sets, np.array(fps, np.int64).view(np.uint64), at[0])):
            a, b = zip(*links, strict=True)
            yield pa.record_batch([pa.array([ids[x] for x in a], pa.int64()), pa.array([ids[x] for x in b], pa.int64())], ["a", "b"])

    for batch in batches:
        for *key, c, fp, found in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if key != at:
                yield from out()
                at, ids, fps, sets = key, [], [], []
            ids.append(c)
            fps.append(fp)
            sets.append(np.frombuffer(found, np.uint64))
    yield from out()


@contextlib.contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """What is made and checkpointed here leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def close_members(classes: DataFrame) -> DataFrame:
    """key, n, cls and fp of classes once for each covering mask under which others agree: any two within the radius of SimHash meet in one."""
    return simhash_covering.sharing(classes.select("fp", "cls").distinct())


def _beyond(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) > simhash_covering.RADIUS


def close_pairs(classes: DataFrame, few: int = BLOCK, members: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of classes within the radius of SimHash that meet under a mask with at most `few` classes; the others are compared in blocks."""
    some = (close_members(classes) if members is None else members).where(F.col("n") <= few)
    a, b = (some.select("key", F.col("cls").alias(x), F.col("fp").alias(f"f{x}")) for x in "ab")
    return a.join(shuffled(b), "key").where((F.col("a") < F.col("b")) & ~_beyond("fa", "fb")).select("a", "b").distinct()


def _dealt(members: DataFrame, by: str, size: str, close: bool, block: int) -> DataFrame:
    """close, part, low, high, cls and fp: the members of each part once for each two blocks that they take part in."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "cls"), blocks.cast("long")).cast("int")
    other = F.explode(F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), blocks - 1), own)))
    rows = members.select(F.col(by).alias("part"), "cls", "fp", own.alias("own"), other.alias("other"))
    return rows.select(F.lit(close).alias("close"), "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "cls", "fp")


def near_links(rows: DataFrame, classes: DataFrame, few: int = FEW, block: int = BLOCK, bits: int = 64, moved: dict[tuple[int, int], int] | None = None) -> DataFrame:
    """Links (a, b) between the classes `(key, tag, cls, fp)` of `rows(key, tag, text)`; their connected parts are those of all pairs of near copies."""
    spark = rows.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _cleaned(spark):
        close = cut(close_members(classes))
    dealt = rows.select("text").mapInArrow(_deal(parts, bits, moved or {}), "bucket long, values binary, place binary, cls binary, n binary")
    shared = dealt.repartitionById(parts, F.col("bucket").cast("int")).mapInArrow(_shared, "shingle long, cls long, n long, freq long")
    of_class = Window.partitionBy("cls")
    ranked = shared.withColumns({"rank": F.row_number().over(of_class.orderBy("freq", "shingle")), "held": F.count("*").over(of_class)})
    with _cleaned(spark):
        prefix = cut(ranked.where(F.col("rank") <= F.col("held") - F.floor((F.col("n") * NUM + DEN - 1) / DEN) + 1).select("shingle", "cls", "n"))
    counts = prefix.groupBy("shingle").agg(F.count("*").alias("members")).where("members > 1")
    members = prefix.join(shuffled(counts), "shingle").join(shuffled(classes.select("cls", "fp").distinct()), "cls")
    some = members.where(F.col("members") <= few)
    a, b = (some.select("shingle", F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("fp").alias(f"f{x}")) for x in "ab")
    near = a.join(shuffled(b), "shingle").where("a < b").where(F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM).where(_beyond("fa", "fb"))
    pairs = cut(near.select("a", "b").distinct().union(close_pairs(classes, few, close)))
    many = _dealt(members.where(F.col("members") > few), "shingle", "members", False, block).union(_dealt(close.where(F.col("n") > few), "key", "n", True, block))
    many = cut(many)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).union(many.select("cls")).distinct()
    first = classes.select("cls", "key", "tag").join(shuffled(wanted), "cls").groupBy("cls").agg(F.min(F.struct("key", "tag")).alias("row"))
    first = first.select(F.col("cls").alias("_c"), F.col("row.key").alias("_k"), F.col("row.tag").alias("_t"))
    held = rows.select("key", "tag", "text").join(shuffled(first), (F.col("key") == F.col("_k")) & (F.col("tag") == F.col("_t"))).select(F.col("_c").alias("cls"), "text")
    with _cleaned(spark):
        sets = cut(map_batches(held, _sets, "cls long, found binary").dropDuplicates(["cls"]))
    left, right = sets.select(F.col("cls").alias("a"), F.col("found").alias("fa")), sets.select(F.col("cls").alias("b"), F.col("found").alias("fb"))
    checked = map_batches(pairs.join(shuffled(left), "a").join(shuffled(right), "b").select("a", "b", "fa", "fb"), _check, "a long, b long")
    grouped = many.join(shuffled(sets), "cls").select("close", "part", "low", "high", "cls", "fp", "found").repartition(parts, "close", "part", "low", "high")
    with _cleaned(spark):
        return cut(checked.union(grouped.sortWithinPartitions("close", "part", "low", "high").mapInArrow(_blocks, "a long, b long")))


def _keyed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns with 128 bits of the whole row as (_key, _tag)."""
    parts = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return docs.select(*columns, F.xxhash64(F.lit(1), *parts).alias("_key"), F.xxhash64(F.lit(2), *reversed(parts)).alias("_tag"))


def near_components(docs: DataFrame, bits: int = 64, **options) -> DataFrame:
    """doc_id, key and tag of each row, and its component: near copies, and near copies of those, share one.

    Null and empty texts are copies of each other. No rows give no rows. Texts are taken for the same set of shingles if 128 bits of it agree, of which `bits` and more
    where these clash number it.
    """
    rows = _keyed(docs, "doc_id", "text").select("doc_id", F.col("_key").alias("key"), F.col("_tag").alias("tag"), "text")
    schema = "doc_id long, key long, tag long, cls long, wide long, fp long"
    classes = cut(map_batches(rows, _classes(bits), schema))
    moved = clashes(classes)
    classes = map_batches(classes, _moved(moved), schema) if moved else classes
    found = components(near_links(rows, classes, bits=bits, moved=moved, **options))
    return classes.join(shuffled(found), classes.cls == found.node, "left").select("doc_id", "key", "tag", F.coalesce("component", "cls").alias("component"))


def drop_near_texts(docs: DataFrame, **options) -> DataFrame:
    """All columns of one row of each component: that with the least doc_id (null last), and then the least hash of the row.

    Rows that agree in all columns have one hash; one of them is kept.
    """
    found = near_components(docs, **options).groupBy("component", "key", "tag").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    found = cut(found)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "tag")).alias("first"))
    first = first.select("first.key", "first.tag")
    repeated = cut(found.where("rows > 1").select("key", "tag").join(shuffled(first), ["key", "tag"], "left_semi"))
    gone = found.select("key", "tag").join(shuffled(first), ["key", "tag"], "left_anti").union(repeated)
    gone, repeated = (x.select(F.col("key").alias("_key"), F.col("tag").alias("_tag")) for x in (gone, repeated))
    rows = _keyed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    kept = rows.join(shuffled(gone), ["_key", "_tag"], "left_anti")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(shuffled(repeated), ["_key", "_tag"], "left_semi").dropDuplicates(["_key", "_tag"]))
    return kept.select("_row.*")
