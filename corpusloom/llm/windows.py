"""Windows of tokens that recur, and where each begins first: the frame that substring operators share.

The phrase of a window is its run of `gram` tokens with the least hash. Equal windows have equal phrases, and neighbouring windows mostly
share one, so a run of windows with one phrase (a segment) is one row. A phrase that stands at one place only is dropped. Equal segments
are one content with a count, told apart by a keyed 128-bit digest of their bytes. The contents of a phrase meet in one task, whose solver
finds the windows that recur; this frame removes nothing by itself. A phrase with more contents than `most` is dealt to several tasks.
Each of these counts its windows by digest first, and is told the counts of those that recur, over all tasks of the phrase.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, powers, rolling, sliding_min, small_batches, utf8

BYTES, WORDS = "bytes", "words"
#: Odd bases of the hashes that choose phrases; equality is never decided by them.
GRAM_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes of texts that are taken together (a longer text is taken alone); rows of an output batch.
TOGETHER, BATCH = 1 << 20, 20_000
#: An order for rows without one.
LAST = (1 << 63) - 1
_digest = functools.partial(hashlib.blake2b, digest_size=16, key=b"windows that recur")

SEGMENT = "key long, tag long, ord long, digit long, c1 long, c2 long, begin int, windows int, multi boolean"
CONTENT = "digit long, stream int, kind int, c1 long, c2 long, n long, last long, ord long, key long, tag long, begin int, windows int, body binary"
CONTENT_ARROW = pa.schema([(name, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind]) for name, kind in map(str.split, CONTENT.split(", "))])
RUN = "struct<low:int,high:int,ord:long,key:long,tag:long,at:int>"
FOUND = f"digit long, c1 long, c2 long, runs array<{RUN}>"


class Content(NamedTuple):
    """Windows with one phrase that stand one after another: how often, in which rows, and where first. No body: nothing to compare with."""

    digit: int
    stream: int
    kind: int
    c1: int
    c2: int
    n: int
    last: int
    ord: int
    key: int
    tag: int
    begin: int
    windows: int
    body: bytes | None


class Told(NamedTuple):
    """What is known of a window of a phrase that several tasks share."""

    n: int
    last: int
    first: tuple[int, int, int, int]


class Runs(NamedTuple):
    """Of content `owner` (ascending), windows from low to high (exclusive) recur; the first of them begins first at place `at` of a row."""

    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    ord: np.ndarray
    key: np.ndarray
    tag: np.ndarray
    at: np.ndarray


Solver = Callable[[list[Content], dict[tuple[int, bytes], Told]], Runs]


def groups_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def word_bounds(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words of texts that stand in `x` one after another."""
    word = ~((x == 32) | ((x >= 9) & (x <= 13)))
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    heads = starts[starts < len(x)]
    begin[heads] = word[heads]
    close = word.copy()
    close[:-1] &= ~word[1:]
    tails = ends[ends > 0] - 1
    close[tails] = word[tails]
    return np.flatnonzero(begin), np.flatnonzero(close) + 1


def word_hashes(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(WORD_BASE, max(1, len(x)))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[: len(x)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(GRAM_BASE))


def segments(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of texts whose tokens stand in `x` one after another: text, begin, windows, digit of the phrase, and whether the phrase
    stands at several places of the text."""
    w = length - gram + 1
    hashes = rolling(x, gram, GRAM_BASE)
    least = sliding_min(hashes, w)
    if not len(least):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    first = np.concatenate([[True], least[1:] != least[:-1]])
    first[starts[starts < len(first)]] = True
    stop = ends - length + 1
    first[stop[(stop > 0) & (stop < len(first))]] = True
    begin = np.flatnonzero(first)
    windows = np.diff(np.append(begin, len(least)))
    text = np.searchsorted(starts, begin, side="right") - 1
    inside = begin + length <= ends[text]
    # places whose phrase is the least of a window
    valid = np.repeat(inside, windows)
    pad = np.zeros(w - 1, np.uint64)
    top = ~sliding_min(~np.concatenate([pad, np.where(valid, least, np.uint64(0)), pad]), w)
    at = np.flatnonzero(top == hashes)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    owner = np.searchsorted(starts, at, side="right").astype(np.uint64)
    again = (hashes[at][1:] == hashes[at][:-1]) & (owner[1:] == owner[:-1])
    salt = np.uint64(0x2545F4914F6CDD1D)
    begin, windows, text = begin[inside], windows[inside], text[inside]
    digit = least[begin]
    multi = np.isin(digit ^ (text + 1).astype(np.uint64) * salt, hashes[at][1:][again] ^ owner[1:][again] * salt)
    return text, begin - starts[text], windows, digit, multi


def _sieve(unit: str, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = utf8(batch)
            for i, j in groups_of(offsets, TOGETHER):
                if unit == WORDS:
                    raw = [b" ".join(data[a:b].tobytes().split()) for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]
                    sizes = np.array([0, *map(len, raw)], np.int64).cumsum()
                    raw = b"".join(raw)
                    x = np.frombuffer(raw, np.uint8)
                    s, e = word_bounds(x, sizes[:-1], sizes[1:])
                    starts, ends = np.searchsorted(s, sizes[:-1]), np.searchsorted(s, sizes[1:])
                    text, begin, windows, digit, multi = segments(word_hashes(x, s, e), starts, ends, length, gram)
                    low = s[starts[text] + begin]
                    high = e[starts[text] + begin + windows - 2 + length]
                else:
                    raw = data[offsets[i] : offsets[j]].tobytes()
                    starts, ends = offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i]
                    text, begin, windows, digit, multi = segments(np.frombuffer(raw, np.uint8), starts, ends, length, gram)
                    low = starts[text] + begin
                    high = low + windows - 1 + length
                if not len(text):
                    continue
                view = memoryview(raw)
                codes = np.frombuffer(b"".join([_digest(view[a:b]).digest() for a, b in zip(low.tolist(), high.tolist(), strict=True)]), np.int64).reshape(-1, 2)
                rows = pa.array(text + i)
                yield pa.record_batch(
                    [*(batch.column(k).take(rows) for k in range(3)), pa.array(digit.view(np.int64)), pa.array(codes[:, 0]), pa.array(codes[:, 1]), pa.array(begin.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(multi)],
                    ["key", "tag", "ord", "digit", "c1", "c2", "begin", "windows", "multi"],
                )

    return run


def _bodies(unit: str, length: int):
    """Contents with their bytes (words joined by one space), from rows of texts and the contents that begin first in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, tag, order, text, parts in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                words = raw.split() if unit == WORDS else []
                for p in parts:
                    a, b = p["begin"], p["begin"] + p["windows"] - 1 + length
                    body = b" ".join(words[a:b]) if unit == WORDS else raw[a:b]
                    size += len(body)
                    rows.append((p["digit"], p["stream"], 1, p["c1"], p["c2"], p["n"], p["last"], order, key, tag, a, p["windows"], body))
                    if size > 4 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CONTENT_ARROW.types, strict=True)], CONTENT_ARROW)
                        rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CONTENT_ARROW.types, strict=True)], CONTENT_ARROW)

    return run


def places_of(lot: list[Content]) -> tuple[np.ndarray, Callable[[np.ndarray], tuple[np.ndarray, ...]]]:
    """For each content a number that puts where it stands first in order (row, then place), and back from these numbers to ord, key, tag and at."""
    rows = sorted({c[7:10] for c in lot})
    rank = {r: i for i, r in enumerate(rows)}
    table = np.array(rows, np.int64).reshape(-1, 3)
    return np.array([(rank[c[7:10]] << 32) + c.begin for c in lot], np.int64), lambda x: (*table[x >> 32].T, x & 0xFFFFFFFF)


def window_digests(c: Content, unit: str, length: int) -> list[bytes]:
    """Digest of each window of a content."""
    view = memoryview(c.body)
    if unit == BYTES:
        return [_digest(view[a : a + length]).digest() for a in range(c.windows)]
    ends = np.cumsum([len(w) + 1 for w in c.body.split(b" ")])
    starts = np.concatenate([[0], ends])
    return [_digest(view[a : b - 1]).digest() for a, b in zip(starts[: c.windows].tolist(), ends[length - 1 :].tolist(), strict=True)]


def _count(unit: str, length: int):
    """For each window of the contents of shared phrases: its digest and what its content says of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = Content(*row)
                d = np.frombuffer(b"".join(window_digests(c, unit, length)), np.int64).reshape(-1, 2)
                n = len(d)
                whole = [pa.array(np.full(n, x)) for x in (c.digit, c.n, c.last, c.ord, c.key, c.tag)]
                yield pa.record_batch([whole[0], pa.array(np.full(n, c.stream, np.int32)), pa.array(d[:, 0]), pa.array(d[:, 1]), *whole[1:], pa.array(np.arange(c.begin, c.begin + n, dtype=np.int32))], ["digit", "stream", "c1", "c2", "n", "last", "ord", "key", "tag", "begin"])

    return run


def _solve(solver: Solver, unit: str, tokens: int):
    """Lots of whole phrases, of about `tokens` tokens, to the solver; rows come sorted by phrase and stream, what is told first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: list[Content] = []
        told: dict[tuple[int, bytes], Told] = {}
        size, at = 0, None

        def out() -> Iterator[pa.RecordBatch]:
            runs = solver(lot, told)
            if len(runs.owner):
                owners, counts = np.unique(runs.owner, return_counts=True)
                got = [lot[i] for i in owners.tolist()]
                fields = [pa.array(a.astype(np.int32 if k in ("low", "high", "at") else np.int64)) for k, a in runs._asdict().items() if k != "owner"]
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], counts.cumsum()]), pa.int32()), pa.StructArray.from_arrays(fields, ["low", "high", "ord", "key", "tag", "at"]))
                yield pa.record_batch([*(pa.array([getattr(c, k) for c in got], pa.int64()) for k in ("digit", "c1", "c2")), listed], ["digit", "c1", "c2", "runs"])
            lot.clear()
            told.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = Content(*row)
                if c.kind and lot and c[:5] == lot[-1][:5]:
                    continue  # of a repeated row
                if c[:2] != at:
                    if size >= tokens:
                        yield from out()
                        size = 0
                    at = c[:2]
                if c.kind:
                    lot.append(c)
                    size += 1 if c.body is None else len(c.body) if unit == BYTES else c.windows
                else:
                    told[c.digit, np.array([c.c1, c.c2], np.int64).tobytes()] = Told(c.n, c.last, (c.ord, c.key, c.tag, c.begin))
        if lot:
            yield from out()

    return run


def alone(lot: list[Content], at: list[int]) -> Runs:
    """All windows of the contents `at`, as they begin in the row where the content stands first."""
    c = [lot[i] for i in at]
    return Runs(*(np.array(x, np.int64) for x in (at, [0] * len(c), [x.windows for x in c], [x.ord for x in c], [x.key for x in c], [x.tag for x in c], [x.begin for x in c])))


def joined_runs(owner: np.ndarray, off: np.ndarray, first: np.ndarray, place: Callable[[np.ndarray], tuple[np.ndarray, ...]]) -> Runs:
    """Runs of windows `off` of contents `owner` (both ascending) whose first places stand side by side; `place` turns these into ord, key, tag and at."""
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (off[1:] != off[:-1] + 1) | (first[1:] != first[:-1] + 1)])[: len(owner)])
    stop = np.append(new[1:], len(owner))[: len(new)] - 1
    return Runs(owner[new], off[new], off[stop] + 1, *place(first[new]))


def merged(*runs: Runs) -> Runs:
    every = [np.concatenate(x) for x in zip(*runs, strict=True)]
    order = np.argsort(every[0], kind="stable")
    return Runs(*(x[order] for x in every))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns with two 64-bit hashes of doc_id and text, which tell rows apart, dealt out by them."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(*columns, F.xxhash64("doc_id", "text").alias("_key"), F.xxhash64("text", F.lit(1), "doc_id").alias("_tag")).repartition(parts, "_key", "_tag")


def recurring(dealt: DataFrame, docs: DataFrame, solver: Solver, gone: Callable[[Column], Column] | None, *, unit: str, length: int, gram: int, most: int, tokens: int, across: bool = False) -> DataFrame:
    """_key, _tag and _spans: where windows begin that are to go, as an array of (low, high). `docs` has doc_id and text, `dealt` is keyed() of it.

    Rows come in the order of doc_id (null last), then of their hashes. `gone` says of a run of recurring windows whether it goes from the place that is at
    hand (columns ord, key, tag, begin); without it, all go. `across`: only windows of rows with different doc_ids count; null doc_ids are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord")
    rows = docs.where(F.octet_length("text") >= (length if unit == BYTES else 2 * length - 1))
    rows = (rows.where("doc_id is not null") if across else rows).select(F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text", F.lit(1), "doc_id").alias("tag"), order, "text")
    found = cut(rows.mapInArrow(_sieve(unit, length, gram), SEGMENT))
    counted = found.groupBy("digit").agg(F.min("ord").alias("a"), F.max("ord").alias("b"), F.count("*").alias("n"), F.max("multi").alias("m"))
    live = counted.where("a < b" if across else "n > 1 or m").select("digit")
    places = cut(found.join(live, "digit"))

    contents = places.groupBy("digit", "c1", "c2").agg(F.count("*").alias("n"), F.max("ord").alias("last"), F.max("multi").alias("multi"), F.min(F.struct("ord", "key", "tag", "begin")).alias("one"), F.min("windows").alias("windows"))
    kinds = contents.groupBy("digit").agg(F.count("*").alias("kinds"))
    hot = kinds.where(F.col("kinds") > most)
    contents = contents.join(kinds, "digit").withColumn("stream", F.pmod(F.xxhash64("c1"), F.ceil(F.col("kinds") / most)).cast("int"))
    compared = (F.col("kinds") > 1) | F.col("multi") | F.lit(across)
    wanted = contents.where(compared).groupBy(F.col("one.key").alias("_k"), F.col("one.tag").alias("_t"))
    wanted = wanted.agg(F.collect_list(F.struct("digit", "stream", "c1", "c2", "n", "last", F.col("one.begin").alias("begin"), "windows")).alias("parts"))
    # all columns, so that the exchange of `dealt` is used again where spans are joined to it
    sources = dealt.join(wanted, (F.col("_key") == F.col("_k")) & (F.col("_tag") == F.col("_t"))).select(F.col("_key").alias("key"), F.col("_tag").alias("tag"), order, "text", "parts", *(c for c in dealt.columns if c not in ("_key", "_tag", "text")))
    work = bodies = sources.mapInArrow(_bodies(unit, length), CONTENT)
    if not across:
        work = work.union(contents.where(~compared & (F.col("n") > 1)).select("digit", "stream", F.lit(1).alias("kind"), "c1", "c2", "n", "last", "one.ord", "one.key", "one.tag", "one.begin", "windows", F.lit(None).cast("binary").alias("body")))
    if not hot.isEmpty():
        windows = bodies.join(hot.select(F.col("digit").alias("_digit")), F.col("digit") == F.col("_digit"), "left_semi").mapInArrow(_count(unit, length), "digit long, stream int, c1 long, c2 long, n long, last long, ord long, key long, tag long, begin int")
        each = windows.groupBy("digit", "c1", "c2", "stream").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.min(F.struct("ord", "key", "tag", "begin")).alias("one"))
        total = each.groupBy("digit", "c1", "c2").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.min("one").alias("one"), F.collect_set("stream").alias("streams")).where("n > 1")
        work = work.union(total.select("digit", F.explode("streams").alias("stream"), F.lit(0).alias("kind"), "c1", "c2", "n", "last", "one.ord", "one.key", "one.tag", "one.begin", F.lit(0).alias("windows"), F.lit(None).cast("binary").alias("body")))
    solved = work.repartition(parts, "digit", "stream").sortWithinPartitions("digit", "stream", "kind", "c1", "c2").mapInArrow(_solve(solver, unit, tokens), FOUND)

    hits = places.join(solved, ["digit", "c1", "c2"])
    if gone is not None:
        hits = hits.withColumn("runs", F.filter("runs", gone)).where(F.size("runs") > 0)
    shifted = F.transform("runs", lambda r: F.struct((F.col("begin") + r["low"]).alias("low"), (F.col("begin") + r["high"]).alias("high")))
    return hits.select("key", "tag", shifted.alias("s")).groupBy(F.col("key").alias("_k"), F.col("tag").alias("_t")).agg(F.flatten(F.collect_list("s")).alias("_spans"))


def with_spans(docs: DataFrame, *columns: str, **options) -> DataFrame:
    """The columns of docs, and _spans as recurring() has them (null if there are none)."""
    dealt = keyed(docs, *columns)
    spans = recurring(dealt, docs, **options)
    return dealt.join(spans, (F.col("_key") == F.col("_k")) & (F.col("_tag") == F.col("_t")), "left").select(*columns, "_spans")
