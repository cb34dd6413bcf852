"""Packing: order-preserving dynamic programming over the token stream of each batch of documents.

Windows of at most `size` tokens are cut at document ends (free), sentence ends (a small penalty) or, in a stretch
without sentence ends, between other tokens (a larger one); to cut a document that would fit in a window costs more. A window of n tokens is padded to
`size`; a power of two needs no padding but fills as little of a sequence, so it costs a share of that. With f(j) the least cost of cutting the
stream before candidate j at place c(j),

    f(j) = penalty(j) + min over i with c(j) - c(i) <= size of f(i) + padding(c(j) - c(i)),

and padding size - (c(j) - c(i)) makes this size - c(j) + min(f(i) + c(i)) over a sliding range: a monotone queue. The few
candidates at a distance that is a power of two are tried besides.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
from public_tokenizers import PATTERN, path
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe_pairs import byte_letters
from .common import documents, small_batches, texts

SIZE, END_ID = 1024, 0
#: Cost of a cut inside a document, in tokens of padding: at a sentence end, elsewhere. Elsewhere is tried every STRIDE tokens.
SENTENCE_CUT, TOKEN_CUT, STRIDE = 2.0, 12.0, 48
#: Cost of a cut inside a document that fits in a window, besides; cost of a place that a sequence of a power of two leaves free.
FIT_CUT, SHORT = 100.0, 0.5
CACHE = 300_000
#: A space beside other white space: such a text isn't cut at its spaces.
TIED = re.compile(r"\s (?:\s|\Z)")
#: Letters, then ASCII punctuation: the pre-tokenizer's pieces of such a word.
LATIN = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordIds(dict):
    """Ids of whole texts as the tokenizers library gives them; words that recur are looked up.

    The pre-tokenizer begins a new piece at each space that has white space on at most one side, so the text between two such
    spaces can be encoded by itself. Where the vocabulary lists its merges in the order of their ids, which makes ids ranks, new words are
    encoded by tiktoken with those ranks; a word that may hold a special token, and any other vocabulary, by the library itself.
    """

    def __init__(self, file: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(file)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.ends = np.zeros(max(self.tok.get_vocab_size(), *vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if set(".!?Ċ") & set(t)]] = True
        self.marks = sorted({x["content"][:2] for x in spec["added_tokens"]})
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        ranked = [vocab[t] for t in merged] == list(range(len(vocab) - len(merged), len(vocab)))
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.core = None
        if ranked and plain:
            back = {c: b for b, c in enumerate(byte_letters())}
            self.core = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks={bytes(back[c] for c in t): i for t, i in vocab.items()}, special_tokens={})._core_bpe

    def by_library(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if self.core is None or any(m in word for m in self.marks):
            ids = self.by_library(word[1:] if word[:1] == " " else " " + word)
        elif plain := LATIN.fullmatch(word):
            if plain[2]:
                ids = self[plain[1]] + self[" " + plain[2]]
            else:
                ids = array("I", self.core.encode_single_piece(f" {word}".encode())).tobytes()
        else:
            ids = array("I", self.core.encode_ordinary(word[1:] if word[:1] == " " else " " + word)).tobytes()
        self[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self) > CACHE:
            self.clear()
        out = []
        for text in texts:
            if TIED.search(text):
                out.append(self.by_library(text))
                continue
            words = text.split(" ")
            words[0] = " " + words[0]  # the first word has no space before it: a key that no other word has
            out.append(b"".join(map(self.__getitem__, words)))
        return out


def cut_points(
    length: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE, sentence_cut: float = SENTENCE_CUT, token_cut: float = TOKEN_CUT, stride: int = STRIDE, fit_cut: float = FIT_CUT, short: float = SHORT
) -> np.ndarray:
    """Where the cheapest windows of a stream of `length` tokens end, ascending; the last is `length`."""
    if not length:
        return np.zeros(0, np.int64)
    penalty = np.full(length + 1, -1.0)
    penalty[sentence_ends] = sentence_cut
    # whole windows from either end of a document that is longer than one
    begins = np.concatenate([[0], doc_ends[:-1]])
    for a, b in zip(begins[doc_ends - begins > size].tolist(), doc_ends[doc_ends - begins > size].tolist(), strict=True):
        even = np.concatenate([np.arange(a + size, b, size), np.arange(b - size, a, -size)])
        penalty[even[penalty[even] < 0]] = token_cut
    penalty[doc_ends] = 0.0
    penalty[0] = penalty[length] = 0.0
    for tail in (1 << k for k in range(size.bit_length())):
        if tail < length and penalty[length - tail] < 0:
            penalty[length - tail] = token_cut
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > stride)
    if len(wide):
        inner = np.concatenate([np.arange(at[i] + stride, at[i + 1], stride) for i in wide])
        penalty[inner] = token_cut
        at = np.flatnonzero(penalty >= 0)
    inside = at[penalty[at] > 0]
    doc = np.searchsorted(doc_ends, inside)
    penalty[inside[(doc_ends - begins)[doc] <= size]] += fit_cut
    index = np.full(length + 1, -1, np.int64)
    index[at] = np.arange(len(at))
    near: dict[int, list[tuple[int, float]]] = {}
    for k in range(size.bit_length()):
        if 1 << k < size:
            back = at - (1 << k)
            j = np.flatnonzero(back >= 0)
            i = index[back[j]]
            for a, b in zip(j[i >= 0].tolist(), i[i >= 0].tolist(), strict=True):
                near.setdefault(a, []).append((b, short * (size - (1 << k))))
    places, costs = at.tolist(), penalty[at].tolist()
    f = [0.0] * len(places)
    came = [0] * len(places)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])
    for j in range(1, len(places)):
        c = places[j]
        while queue[0][1] < c - size:
            queue.popleft()
        best, _, i = queue[0]
        best += size - c
        if j in near:
            for h, free in near[j]:
                if f[h] + free < best:
                    best, i = f[h] + free, h
        f[j] = best = best + costs[j]
        came[j] = i
        key = best + c
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, c, j))
    out = []
    j = len(places) - 1
    while j:
        out.append(places[j])
        j = came[j]
    return np.asarray(out[::-1], np.int64)


_WORDS: dict[str, WordIds] = {}


def word_ids(file: str) -> WordIds:
    if file not in _WORDS:
        _WORDS[file] = WordIds(file)
    return _WORDS[file]


def pack(docs: DataFrame, file: str, *, size: int = SIZE, end_id: int = END_ID, sentence_cut: float = SENTENCE_CUT, token_cut: float = TOKEN_CUT, stride: int = STRIDE, fit_cut: float = FIT_CUT, short: float = SHORT, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most `size` tokens, in the order of the rows of each partition.

    A null or empty text is the end id alone. A null doc_id is kept; a repeated row is packed again as a document of its own;
    no rows give no pieces; only doc_id and text are read. A text of any length is cut into as many windows as it needs, and a
    batch of documents ends with a window, so memory is bounded by a batch. sequence_id holds the partition's number in its
    upper half and counts within it, so a repeated task gives the same ids. `with_ids` adds the ids of each piece.
    """

    def run(batches):
        words = word_ids(file)
        partition = TaskContext.get().partitionId() << 32
        done = 0
        last = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            raws = [x + last for x in words.encode(texts(batch))]
            lengths = np.asarray([len(x) // 4 for x in raws], np.int64)
            ends = np.cumsum(lengths)
            stream = b"".join(raws)
            ids = np.frombuffer(stream, "<u4")
            cuts = cut_points(len(ids), ends, np.flatnonzero(words.ends[np.minimum(ids, len(words.ends) - 1)]) + 1, size, sentence_cut, token_cut, stride, fit_cut, short)
            stops = np.union1d(cuts, ends)
            starts = np.concatenate([[0], stops[:-1]])
            doc = np.searchsorted(ends, starts, side="right")
            seq = np.searchsorted(cuts, starts, side="right")
            crcs = [zlib.crc32(memoryview(stream)[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            columns = [
                batch.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(starts - (ends - lengths)[doc]), pa.array(stops - starts), pa.array(crcs, pa.int64()),
                pa.array(lengths[doc]), pa.array(partition + done + seq), pa.array(starts - np.concatenate([[0], cuts])[seq]),
            ]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            done += len(cuts)
            yield pa.record_batch(columns, names)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def op10_packing_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), path("byte_bpe_50k.json"))
