"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector of r + 1 bits; for each non-zero v of r + 1 bits, mask v keeps the bits whose vector has
an odd product with v. The vectors of any r differing bits span less than the whole space, so some v is orthogonal to all of
them: every pair within distance r agrees under at least one of the 2^(r+1) - 1 masks. No near pair can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, documents, map_batches, shuffled, small_batches, texts

BITS, RADIUS, WORDS, SEED = 64, 4, 4, 42
#: Most fingerprints of a bucket that one task compares at once are two blocks of this size.
BLOCK = 1024


def fingerprint(raw: bytes, width: int = WORDS, seed: int = SEED) -> int:
    """Unsigned fingerprint: bit i is set if it is set in over half of the shingles' hashes; no words give zero."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(text, seed)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter([digest(text[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64, len(starts)))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    votes = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(t.encode("utf-8", "replace"), width, seed) for t in texts(batch)), np.uint64, batch.num_rows)
        return pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks under one of which any two numbers within the radius agree. Vectors are dealt evenly, in turn."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(fp: Column, radius: int) -> Column:
    return F.explode(F.array(*[F.xxhash64(F.lit(t), fp.bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(covering_masks(radius))]))


def _tree(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius, one less than members for each connected part."""
    n = len(fps)
    todo = np.ones(n, bool)
    links = []
    for s in range(n):
        if not todo[s]:
            continue
        todo[s] = False
        front = [s]
        while front:
            i = front.pop()
            rest = np.flatnonzero(todo)
            if not len(rest):
                break
            near = rest[np.bitwise_count(fps[rest] ^ fps[i]) <= radius]
            todo[near] = False
            links += [(i, j) for j in near.tolist()]
            front += near.tolist()
    return links


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(cols: list[np.ndarray]) -> pa.RecordBatch:
            key, low, high, fps, reps = cols
            fps = fps.view(np.uint64)
            change = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(key)]])
            two = starts[ends - starts == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
            a, b = [two], [two + 1]
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 2 and (found := _tree(fps[s:e], radius)):
                    x = np.asarray(found) + s
                    a.append(x[:, 0])
                    b.append(x[:, 1])
            return pa.record_batch([pa.array(reps[np.concatenate(a)]), pa.array(reps[np.concatenate(b)])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append(tuple(cols))
            key = [c[-1] for c in cols[:3]]
            last = (cols[0] == key[0]) & (cols[1] == key[1]) & (cols[2] == key[2])
            begin = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if begin:
                joined = [np.concatenate(x) for x in zip(*held, strict=True)]
                rest = len(last) - begin
                yield links([c[: len(c) - rest] for c in joined])
                held = [tuple(c[len(c) - rest :] for c in joined)]
        if held:
            yield links([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def sharing(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows, which have `fp`, once for each mask under which more than one agrees, with the `key` of what they agree in and `n`, how many do."""
    keyed = rows.select(_keys(F.col("fp"), radius).alias("key"), *rows.columns)
    return keyed.join(shuffled(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")), "key")


def near_links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the `rep`s of distinct `fp`s; their connected parts are those of all pairs within the radius.

    A bucket of more than `block` fingerprints is dealt into blocks, each two of which one task compares; a task gives the
    links of a forest, so a bucket never gives all its pairs.
    """
    rows = sharing(classes.where("rep is not null").select("fp", "rep"), radius)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "fp"), blocks.cast("long")).cast("int")
    other = F.explode(F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), blocks - 1), own)))
    small_batches(classes.sparkSession)
    members = rows.select("key", "fp", "rep", own.alias("own"), other.alias("other"))
    members = members.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp", "rep")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(_compare(radius), "a long, b long")


def simhash_components(docs: DataFrame, *, width: int = WORDS, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """Per document doc_id, fingerprint, component_id (the least doc_id reachable by links of at most `radius` bits) and kept.

    Null or empty text has fingerprint zero and is linked like any other. A null doc_id gets the component of its fingerprint,
    or null if no document with an id has that fingerprint; repeated rows are all returned and share a component; no rows
    give no rows; only doc_id and text are read. Equal fingerprints are one class, so copies cost one row each; links
    and components are computed between classes, in partitions.
    """
    fps = cut(fingerprints(docs, width, seed))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(near_links(classes, radius))
    known = classes.join(shuffled(found), classes.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(shuffled(known), "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op6_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
