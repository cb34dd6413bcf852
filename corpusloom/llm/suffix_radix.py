"""Suffix-array deduplication by a depth-limited radix sort.

The order of suffixes matters only through the first `length` tokens (the threshold): suffixes that are equal so far stand at repeated
windows. `ordered` sorts the suffixes of a lot of contents by most-significant-digit passes: the first digit of a suffix is its first eight bytes (or
its first word), and each pass doubles the depth, since what follows a suffix that is known to a depth is another one known to that depth. What
is alone in its group after a pass goes no further, and equal groups at the depth limit are exactly the repeated windows. Groups are told
apart by the tokens themselves, never by a hash.

Not all suffixes of a corpus meet in a task: `windows` first deals them out by the phrase that equal windows share, and drops those whose
phrase stands at one place. Equal contents are sorted once, with their count. Windows of a phrase with more than `many`
contents are dealt to several tasks by content, and groups of equal windows are formed there by a keyed 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import covered, documents, runs, utf8
from .windows import BYTES, WORDS, Content, Runs, Told, alone, joined_runs, merged, places_of, window_digests, with_spans, word_bounds

LENGTH, GRAM = 400, 50
#: The threshold and the phrase in words.
WORD_LENGTH, WORD_GRAM = 50, 10
#: Contents of one phrase that meet in one task; tokens that are sorted together, about.
MANY, TOKENS = 4096, 1 << 20


def ordered(x: np.ndarray, depth: int, left: np.ndarray, copied: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of `length` tokens begin that are equal to another (or copied), in order of their tokens, and the group of each.

    x: a digit of `depth` tokens for each place; left: tokens from a place to the end of its content; copied: whether its content stands elsewhere too.
    """
    at = np.flatnonzero(left >= depth)
    digit = x[at]
    rank = np.empty(len(x), np.int64)
    while True:
        order = np.argsort(digit, kind="stable")
        at, digit = at[order], digit[order]
        new = np.ones(len(at), bool)
        new[1:] = digit[1:] != digit[:-1]
        first = np.flatnonzero(new)
        if not len(first):
            return at, at
        alive = (np.diff(np.append(first, len(at))) > 1) | np.logical_or.reduceat(copied[at], first)
        group = np.cumsum(new) - 1
        stays = alive[group]
        at, group = at[stays], group[stays]
        if depth == length:
            return at, group
        rank.fill(-1)
        rank[at] = group
        step = min(depth, length - depth)
        depth += step
        far = left[at] >= depth
        at, group = at[far], group[far]
        then = rank[at + step]
        at, digit = at[then >= 0], group[then >= 0] * len(x) + then[then >= 0]


def digits(bodies: list[bytes], unit: str) -> tuple[np.ndarray, int, np.ndarray]:
    """The first digit of each suffix of the bodies, its depth, and the number of tokens of each body."""
    if unit == BYTES:
        x = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8).astype(np.uint64)
        for width in (1, 2, 4):
            x = (x[:-width] << np.uint64(8 * width)) | x[width:]
        return x[:-1], 8, np.array([len(b) for b in bodies])
    words = [b.split(b" ") for b in bodies]
    rank = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    return np.fromiter((rank[w] for ws in words for w in ws), np.int64), 1, np.array([len(ws) for ws in words])


def radix(unit: str, length: int):
    """Solver: the windows of a lot that are equal to others."""

    def sort(lot: list[Content], some: list[int]) -> Runs:
        number, place = places_of(lot)
        x, depth, sizes = digits([lot[i].body for i in some], unit)
        if depth > length:
            x, depth = x >> np.uint64(8 * (depth - length)), length
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(some)), sizes)
        here = np.arange(len(owner))
        copied = np.array([lot[i].n > 1 for i in some])
        at, group = ordered(x, depth, ends[owner] - here, copied[owner], length)
        if not len(at):
            return alone(lot, [])
        off = at - (ends - sizes)[owner[at]]
        first = number[np.array(some)][owner[at]] + off
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        first = np.repeat(np.minimum.reduceat(first, heads), np.diff(np.append(heads, len(at))))
        order = np.argsort(at)
        return joined_runs(np.array(some)[owner[at]][order], off[order], first[order], place)

    def shared(lot: list[Content], some: list[int], told: dict[tuple[int, bytes], Told]) -> Runs:
        found = [(i, o, *t.first) for i in some for o, d in enumerate(window_digests(lot[i], unit, length)) if (t := told.get((lot[i].digit, d)))]
        if not found:
            return alone(lot, [])
        owner, off, order, key, tag, at = np.array(found, np.int64).T
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (off[1:] != off[:-1] + 1) | (order[1:] != order[:-1]) | (key[1:] != key[:-1]) | (tag[1:] != tag[:-1]) | (at[1:] != at[:-1] + 1)
        new = np.flatnonzero(new)
        return Runs(owner[new], off[new], off[np.append(new[1:], len(owner)) - 1] + 1, order[new], key[new], tag[new], at[new])

    def solve(lot: list[Content], told: dict[tuple[int, bytes], Told]) -> Runs:
        hot = {digit for digit, _ in told}
        whole = [i for i, c in enumerate(lot) if c.body is None]
        some = [i for i, c in enumerate(lot) if c.body is not None and c.digit not in hot]
        rest = [i for i, c in enumerate(lot) if c.body is not None and c.digit in hot]
        return merged(alone(lot, whole), *([sort(lot, some)] if some else []), *([shared(lot, rest, told)] if rest else []))

    return solve


def later(r: Column) -> Column:
    """Whether a run begins earlier elsewhere than here."""
    return F.struct(F.col("ord"), F.col("key"), F.col("tag"), F.col("begin") + r["low"]) > F.struct(r["ord"], r["key"], r["tag"], r["at"])


def _kept(x: np.ndarray, spans: list[dict] | None, length: int, unit: str = BYTES) -> tuple[np.ndarray, int]:
    """Bytes that stay and the number of maximal removed runs. A removed word takes the white space behind it along."""
    if not spans:
        return x, 0
    lows = np.fromiter((s["low"] for s in spans), np.int64)
    highs = np.fromiter((s["high"] for s in spans), np.int64) - 1 + length
    if unit == WORDS:
        begin, _ = word_bounds(x, np.zeros(1, np.int64), np.array([len(x)]))
        begin = np.append(begin, len(x))
        lows, highs = begin[lows], begin[highs]
    gone = covered(len(x), lows, highs)
    return x[~gone], len(runs(gone)[0])


def suffix_dedup(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, many: int = MANY, with_text: bool = False) -> DataFrame:
    """Per document doc_id, n_bytes, n_removed, n_spans and kept_sha256 (and the kept text, if asked for).

    Every byte of a window of `length` bytes that also begins elsewhere is removed. Null text is empty; empty and shorter texts
    lose nothing. Rows are told apart by doc_id and text: repeated rows repeat each other, and both lose what is long
    enough; null doc_ids are kept. No rows give no rows; other columns are not read. In kept text, a character that a cut divides is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = utf8(batch)
            rows = []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                x = data[offsets[i] : offsets[i + 1]]
                kept, n = _kept(x, spans, length)
                raw = kept.tobytes()
                rows.append((len(x), len(x) - len(raw), n, hashlib.sha256(raw).hexdigest(), *([raw.decode("utf-8", "ignore")] if with_text else [])))
            yield pa.record_batch([batch.column(0).cast(pa.int64()), *map(pa.array, zip(*rows, strict=True))], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text
    names = [x.split()[0] for x in schema.split(", ")]
    found = with_spans(docs.select("doc_id", "text"), "doc_id", "text", solver=radix(BYTES, length), gone=None, unit=BYTES, length=length, gram=gram, most=many, tokens=TOKENS)
    return found.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, unit: str = WORDS, length: int = WORD_LENGTH, gram: int = WORD_GRAM, many: int = MANY) -> DataFrame:
    """The documents, with all columns, without windows of `length` words (or bytes) that begin earlier in the corpus too; n_chars, if there is one, counts what is left.

    The first place of a window keeps it: that in the row with the least doc_id (null last; then by a hash of doc_id and text), and there the first. A removed word
    takes the white space behind it along. Null text stays null and empty text empty; a text may be left empty. Rows that agree in doc_id and text are
    one place, so repeated rows lose alike. No rows give no rows; columns may have any names.
    """
    names, schema = docs.columns, docs.schema
    rest = [n for n in names if n not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", *([F.struct(*(F.col(f"`{n}`") for n in rest)).alias("_rest")] if rest else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = utf8(batch)
            found = batch.column(batch.schema.get_field_index("_spans")).to_pylist()
            nulls = batch.column(1).is_null().to_pylist()
            texts = [None if null else _kept(data[offsets[i] : offsets[i + 1]], spans, length, unit)[0].tobytes().decode("utf-8", "ignore") for i, (spans, null) in enumerate(zip(found, nulls, strict=True))]
            columns = {"doc_id": batch.column(0), "text": pa.array(texts, pa.string())}
            columns |= {n: c for n, c in zip(rest, batch.column(2).flatten(), strict=True)} if rest else {}
            if "n_chars" in rest:
                columns["n_chars"] = pa.array([old if spans is None else len(t) for t, old, spans in zip(texts, columns["n_chars"].to_pylist(), found, strict=True)], columns["n_chars"].type)
            yield pa.record_batch([columns[n] for n in names], names)

    found = with_spans(packed, *packed.columns, solver=radix(unit, length), gone=later, unit=unit, length=length, gram=gram, most=many, tokens=TOKENS if unit == BYTES else TOKENS >> 2)
    return found.mapInArrow(run, StructType(schema.fields))


def op9_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))
