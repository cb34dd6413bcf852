"""BPE encoding and decoding with a pair occurrence index.

All new words of a batch are laid out in one array of symbols. An index maps each mergeable pair to every position
where it stands; active ranks are applied in ascending order, each at all its positions, and only the lists of the
pairs beside a merge are updated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable
from operator import itemgetter

import pyarrow as pa
from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from .common import documents, map_batches, texts

#: Words that normalise to their lower case alone: printable ASCII and precomposed Latin letters.
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ž]+")
LETTER = "a-zß-öø-ž"
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")
#: Words kept with their tokens between batches.
CACHE = 500_000
COUNT = itemgetter(2)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it prints, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class PairIndexBpe:
    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = byte_letters()
        self.first = [vocab.get(c) for c in self.letters]
        self.last = [vocab.get(c + self.suffix) for c in self.letters]
        self.merges: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.pairs: list[tuple[int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank
            self.pairs.append((vocab[a], vocab[b]))
            self.made.append(vocab[a + b])
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.file = file
        self.slow = None
        self.cache: dict[bytes, tuple[str, str, int]] = {}
        self.known: dict[bytes, list[int]] = {}

    def pieces(self, word: str) -> list[bytes]:
        """Normalised pieces of a word without white space, as bytes."""
        if PLAIN.fullmatch(word):
            return [p.encode() for p in PIECE.findall(word.lower())]
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.file)
            self.back = {c: b for b, c in enumerate(self.letters)}
        found = self.slow.pre_tokenizer.pre_tokenize_str(self.slow.normalizer.normalize_str(word))
        return [bytes(self.back[c] for c in p) for p, _ in found]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Tokens of each piece: the pair occurrence index over all pieces at once."""
        symbols: list[int] = []
        starts: list[int] = []
        for p in pieces:
            starts.append(len(symbols))
            symbols.extend(map(self.first.__getitem__, p[:-1]))
            symbols.append(self.last[p[-1]])
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for s in starts:
            before[s] = -1
            if s:
                after[s - 1] = -1
        if n:
            after[n - 1] = -1
        merges, made, both = self.merges, self.made, self.pairs
        where: dict[int, list[int]] = {}
        get = merges.get
        for i in range(n):
            j = after[i]
            if j >= 0 and (rank := get((symbols[i], symbols[j]))) is not None:
                if rank in where:
                    where[rank].append(i)
                else:
                    where[rank] = [i]
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            at = where.pop(rank)
            left, right = both[rank]
            new = made[rank]
            at.sort()
            for i in at:
                if symbols[i] != left or (j := after[i]) < 0 or symbols[j] != right:
                    continue
                symbols[i], symbols[j] = new, -1
                after[i] = k = after[j]
                if k >= 0:
                    before[k] = i
                    if (r := get((new, symbols[k]))) is not None:
                        if r in where:
                            where[r].append(i)
                        else:
                            where[r] = [i]
                            heapq.heappush(active, r)
                if (h := before[i]) >= 0 and (r := get((symbols[h], new))) is not None:
                    if r in where:
                        where[r].append(h)
                    else:
                        where[r] = [h]
                        heapq.heappush(active, r)
        ends = [*starts[1:], n]
        return [[x for x in symbols[s:e] if x >= 0] for s, e in zip(starts, ends, strict=True)]

    def learn(self, words: Iterable[bytes]) -> None:
        """Put the tokens of new words into the cache."""
        plans: list[tuple[bytes, list[int | bytes]]] = []
        known, new = self.known, dict[bytes, None]()
        for raw in words:
            word = raw.decode("utf-8", "replace")
            plan: list[int | bytes] = []
            parts = self.split_special.split(word) if self.split_special and "<|" in word else [word]
            for part in parts:
                if part in self.special:
                    plan.append(self.special[part])
                elif part:
                    for p in self.pieces(part):
                        if p not in known:
                            new[p] = None
                        plan.append(p)
            plans.append((raw, plan))
        known.update(zip(new, self.encode_pieces(list(new)), strict=True))
        for raw, plan in plans:
            ids: list[int] = []
            for p in plan:
                if isinstance(p, int):
                    ids.append(p)
                else:
                    ids += known[p]
            self.cache[raw] = (" ".join(map(str, ids)), self.decode(ids), len(ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; the vocabulary has no decoder, so tokens are joined by spaces and ids without a token are left out."""
        get = self.tokens.get
        return " ".join([t for i in ids if (t := get(i)) is not None])

    def encode_words(self, raws: list[bytes]) -> Iterable[list[tuple[str, str, int]]]:
        """For each text the (ids, decoded text, number of ids) of its words."""
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
            self.known.clear()
        split = [raw.split() for raw in raws]
        if new := set().union(*split) - cache.keys():
            self.learn(new)
        for words in split:
            rows = list(map(cache.__getitem__, words))
            yield rows if all(map(COUNT, rows)) else [x for x in rows if x[2]]

    def encode(self, text: str) -> list[int]:
        return [int(i) for rows in self.encode_words([text.encode("utf-8", "replace")]) for x in rows for i in x[0].split()]


_MODELS: dict[str, PairIndexBpe] = {}


def model(file: str) -> PairIndexBpe:
    if file not in _MODELS:
        _MODELS[file] = PairIndexBpe(file)
    return _MODELS[file]


def bpe_encode(docs: DataFrame, file: str, *, text: str = "text", id: str = "doc_id", outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Encode and decode every whole text: `id`, n_tokens and the `outputs` (ids, decoded, ids_sha256, decoded_sha256).

    Null or empty text: no tokens, digests of the empty string. Null ids are kept; repeated rows give repeated rows; no rows
    give no rows; only the two columns named are read. A text's words are cut at ASCII white space first, which no token
    crosses, so a long text costs memory in proportion to one batch only.
    """
    kinds = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = model(file)
        rows: dict[str, list] = {k: [] for k in ("n_tokens", *outputs)}
        for words in bpe.encode_words([t.encode("utf-8", "replace") for t in texts(batch, text)]):
            coded, decoded, counts = zip(*words, strict=True) if words else ((), (), ())
            rows["n_tokens"].append(sum(counts))
            ids = " ".join(coded) if {"ids", "ids_sha256"} & {*outputs} else ""
            said = " ".join(decoded) if {"decoded", "decoded_sha256"} & {*outputs} else ""
            for k in outputs:
                rows[k].append([int(i) for i in ids.split()] if k == "ids" else said if k == "decoded" else hashlib.sha256((ids if k == "ids_sha256" else said).encode()).hexdigest())
        return pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(rows["n_tokens"], pa.int64()), *(pa.array(rows[k], kinds[k][1]) for k in outputs)], [id, "n_tokens", *outputs])

    return map_batches(docs.select(id, text), run, ", ".join([f"{id} long", "n_tokens long", *(f"{k} {kinds[k][0]}" for k in outputs)]))


def bpe_decode(encoded: DataFrame, file: str, *, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """`id` and decoded text of arrays of ids; null arrays give empty text, unknown or null ids are left out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = model(file)
        return pa.record_batch([batch.column(0).cast(pa.int64()), pa.array([bpe.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())], [id, "decoded"])

    return map_batches(encoded.select(id, ids), run, f"{id} long, decoded string")


def op5_bpe_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(documents(spark, sf_dir), path("word_bpe_49k.json"), outputs=("ids_sha256", "decoded_sha256"))
