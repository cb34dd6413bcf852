"""Periodic runs: stretches of words that repeat with a period, found by the divide and conquer of Main and Lorentz.

Words become numbers, and the words of a batch are halved again and again. A run of at least four periods lies inside the smallest of these blocks that
holds it whole, across its middle, with two periods on one side at least. The Z-functions of both halves, forwards and backwards, say for every period how far
words agree on either side of the middle, which gives all runs that cross it. Every block of a size is first looked at in one sweep over the batch: one whose
middle has too few equal words at every distance can't have such a run, and no Z-functions are made for it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import covered, documents, map_batches

#: A run has so many words and so many periods at least. The sweep relies on two periods on one side of a middle, so on four in all.
LEAST, PERIODS = 6, 4
#: Words that a sweep compares beside a middle at most; more would only spare a few blocks their Z-functions.
LOOK = 12
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

Run = tuple[int, int, int]


def z_function(x: Sequence[int]) -> list[int]:
    """For each place how many items from there on agree with the beginning; all of them at place 0."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(left: list[int], right: list[int]) -> list[Run]:
    """Stretches (start, length, period) of left + right that hold two periods of one side beside the middle, and as much more as agrees.

    For period q of the right side: how far right[q:] agrees with right, and how far back left agrees with what ends q later.
    """
    a, b = len(left), len(right)
    ahead = np.array(z_function(right))
    both = np.array(z_function([*left[::-1], -1, *right[::-1], *left[::-1]]))[a + 1 :]  # at i: how far back from the last word but i agrees with the end of left
    behind = np.array(z_function(left[::-1]))
    back = np.array(z_function([*right, -1, *left, *right]))[b + 1 :]  # at i: how far from word i on agrees with right
    found: list[Run] = []
    q = np.arange(1, b // 2 + 1)
    q = q[ahead[q] >= q]
    before = both[b - q]
    found += zip((a - before).tolist(), (before + q + ahead[q]).tolist(), q.tolist(), strict=True)
    q = np.arange(1, a // 2 + 1)
    q = q[behind[q] >= q]
    after = back[a - q]
    found += zip((a - q - behind[q]).tolist(), (behind[q] + q + after).tolist(), q.tolist(), strict=True)
    return found


def may_cross(words: np.ndarray, half: int, most: int) -> np.ndarray:
    """The middles of blocks of 2 * half words that have enough equal words beside them for a run of period `most` or less."""
    blocks = words[: len(words) // (2 * half) * 2 * half].reshape(-1, 2 * half)
    longest = min(half // 2, most)
    hit = np.zeros(len(blocks), bool)
    for side in (blocks[:, half:], blocks[:, half - 1 :: -1]):
        low = 1
        while low <= longest:  # periods that have to agree on equally many words: 1, 2, 3 and so on
            need = min(max(low, LEAST // 2 - low), LOOK)
            high = longest if need == LOOK else low
            same = side[:, :1] == side[:, low : high + 1]
            for j in range(1, need):
                same &= side[:, j : j + 1] == side[:, low + j : high + 1 + j]
            hit |= same.any(axis=1)
            low = high + 1
    return np.flatnonzero(hit) * 2 * half + half


def batch_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[Run]]:
    """All runs of each text words[start:end], by start, then period. Between texts, `words` has numbers that no other place has, and so after the last."""
    n = len(words)
    longest = int((ends - starts).max(initial=0))
    size = max(8, 1 << max(n - 1, 0).bit_length())
    held = np.concatenate([words, -1 - n - np.arange(size - n, dtype=words.dtype)])  # filled up to the last block, which holds everything
    found: list[dict[tuple[int, int], int]] = [{} for _ in starts]
    half = 4
    while 2 * half <= size:
        for middle in may_cross(held, half, longest // PERIODS).tolist():
            text = int(np.searchsorted(starts, middle, "right")) - 1
            if text < 0 or not starts[text] < middle < ends[text]:
                continue
            low, high = max(middle - half, int(starts[text])), min(middle + half, int(ends[text]))
            for at, length, q in crossing(words[low:middle].tolist(), words[middle:high].tolist()):
                first, last = low + at, low + at + length
                if length < max(LEAST, PERIODS * q):
                    continue
                if (first > starts[text] and words[first - 1] == words[first - 1 + q]) or (last < ends[text] and words[last] == words[last - q]):
                    continue  # it goes on, so a larger block holds it whole
                key = (first - int(starts[text]), length)
                found[text][key] = min(q, found[text].get(key, q))
        half *= 2
    return [sorted((at, length, q) for (at, length), q in runs.items()) for runs in found]


def planted(words: list[bytes], doc: int) -> list[bytes]:
    """The words, of which a tail repeats itself in every tenth document, as the contract of the query has it."""
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; of several the first, then the one of the smallest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def described(words: list[bytes], runs: list[Run]) -> tuple:
    """The columns of SCHEMA after doc_id."""
    best = strongest(runs)
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if runs:
        gone = covered(len(words), np.array([s + q for s, _, q in runs]), np.array([s + n for s, n, _ in runs]))
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, listed, hashlib.sha256(b" ".join(words)).hexdigest())


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts as numbers, each text followed by a number of its own, and where texts begin and end."""
    ids: dict[bytes, int] = {}
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    words = np.empty(int((sizes + 1).sum()), np.int32)
    for k, (text, end) in enumerate(zip(texts, ends.tolist(), strict=True)):
        words[end - len(text) : end] = np.fromiter((ids.setdefault(w, len(ids)) for w in text), np.int32, len(text))
        words[end] = -1 - k
    return words, ends - sizes, ends


def periodic_runs(docs: DataFrame, *, plant: bool = False) -> DataFrame:
    """Per document the number of runs, the strongest one, and digests of all runs and of the words that are left when each run keeps its first period.

    A run is a stretch of at least LEAST words and PERIODS smallest periods that neither neighbour extends. With `plant`, every tenth document gets a
    repeating tail first (for the query). Null and empty texts have no words and no runs; null doc_ids are kept and get no tail; repeated rows are
    judged alike and all returned; no rows give no rows. Only doc_id and text are read, so other columns may have any name. Texts are taken whole, however long;
    a task holds one batch of them, and the work on n words is at most n log n.
    """

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
        if plant:
            texts = [t if i is None else planted(t, i) for i, t in zip(ids, texts, strict=True)]
        rows = [described(t, r) for t, r in zip(texts, batch_runs(*_numbered(texts)), strict=True)]
        kinds = [*[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.record_batch([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], [c.split()[0] for c in SCHEMA.split(", ")])

    return map_batches(docs.select("doc_id", "text"), judge, SCHEMA)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(documents(spark, sf_dir), plant=True)
