"""Substring deduplication by repeated-phrase automata.

A passage is a window of consecutive words that also begins in a document with a smaller doc_id. `windows` brings the contents that share a phrase
together. Of these, the passages that recur in different documents are confirmed, word by word; Aho-Corasick automata (pyahocorasick, over
numbered words) are compiled of them, a shard for each lot of at most `shard` passages; and the contents of all documents stream
through the automata, which locate every occurrence. Nothing is removed that an automaton hasn't located: equal contents of many documents stream once, and
what is located there holds for all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import covered, documents
from .windows import WORDS, Content, Runs, Told, alone, joined_runs, window_digests, with_spans

WINDOW, GRAM = 50, 10
#: Contents of a phrase that one stream takes; passages of one automaton.
STREAM, SHARD = 2048, 4000


class Letters(dict):
    """A letter for each word, so that a passage is a string; surrogates are left out, and there are as many letters as code points."""

    def __missing__(self, word: bytes) -> str:
        n = len(self) + 1
        self[word] = letter = chr(n if n < 0xD800 else n + 0x800)
        return letter


def confirmed(texts: list[str], lot: list[Content], told: dict[tuple[int, bytes], Told], window: int) -> dict[str, int]:
    """The passages of a lot that recur in different documents, with the first document of each."""
    hot = {digit for digit, _ in told}
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for text, c in zip(texts, lot, strict=True):
        codes = window_digests(c, WORDS, window) if c.digit in hot else None
        for i in range(c.windows):
            passage = text[i : i + window]
            least, most = c.ord, c.last
            if codes and (t := told.get((c.digit, codes[i]))):
                least, most = t.first[0], t.last
            if first.setdefault(passage, least) > least:
                first[passage] = least
            if last.setdefault(passage, most) < most:
                last[passage] = most
    return {p: f for p, f in first.items() if f < last[p]}


def automata(window: int, shard: int):
    """Solver: where the confirmed passages of a lot stand in its contents, as shards of automata find them."""

    def solve(lot: list[Content], told: dict[tuple[int, bytes], Told]) -> Runs:
        letters = Letters()
        texts = ["".join(map(letters.__getitem__, c.body.split(b" "))) for c in lot]
        passages = list(confirmed(texts, lot, told, window).items())
        found: list[tuple[int, int, int]] = []
        for i in range(0, len(passages), shard):
            automaton = ahocorasick.Automaton()
            for passage, first in passages[i : i + shard]:
                automaton.add_word(passage, first)
            automaton.make_automaton()
            for n, text in enumerate(texts):
                found += [(n, end + 1 - window, first) for end, first in automaton.iter(text)]
        if not found:
            return alone(lot, [])
        found.sort()
        owner, off, first = np.array(found, np.int64).T
        # a run goes on while the first document stays the same; its place there doesn't matter
        _, code = np.unique(first, return_inverse=True)
        runs = joined_runs(owner, off, (code << 32) + off, lambda x: (x >> 32, *[np.zeros(len(x), np.int64)] * 3))
        return runs._replace(ord=np.unique(first)[runs.ord])

    return solve


def phrase_dedup(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, stream: int = STREAM, shard: int = SHARD, with_text: bool = False) -> DataFrame:
    """Per document doc_id, n_words, n_removed and kept_sha256 (and the kept words, if asked for).

    A word is removed if a window that covers it also begins in a document with a smaller doc_id; so the first keeps its words, and
    repeats inside one document, repeated rows and rows that share a doc_id don't count. Null text has no words; texts of fewer words than
    a window lose nothing; a null doc_id is neither smaller nor larger than another and its text stays whole. No rows give no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if cuts:
                    gone = covered(n, np.fromiter((c["low"] for c in cuts), np.int64), np.fromiter((c["high"] for c in cuts), np.int64) - 1 + window)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                raw = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(raw).hexdigest(), *([raw.decode("utf-8", "replace")] if with_text else [])))
            yield pa.record_batch([batch.column(0).cast(pa.int64()), *map(pa.array, zip(*rows, strict=True))], names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    names = [x.split()[0] for x in schema.split(", ")]
    found = with_spans(docs.select("doc_id", "text"), "doc_id", "text", solver=automata(window, shard), gone=lambda r: F.col("ord") > r["ord"], unit=WORDS, length=window, gram=gram, most=stream, tokens=shard, across=True)
    return found.mapInArrow(run, schema)


def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup(documents(spark, sf_dir))
