"""Texts of megabytes, with a passage that a short text shares, against plain Python."""

import hashlib
import random
import zlib

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from corpusloom.llm.bpe_pairs import bpe_encode
from corpusloom.llm.compression_bands import compression_bands
from corpusloom.llm.near_texts import near_components
from corpusloom.llm.packing_dp import pack
from corpusloom.llm.phrase_automata import phrase_dedup
from corpusloom.llm.suffix_radix import suffix_dedup

rng = random.Random(11)
PASSAGE = " ".join(f"p{rng.randrange(10**6)}" for _ in range(120))
LONG = " ".join(f"w{rng.randrange(10**5)}" for _ in range(150_000)) + " " + PASSAGE + " " + " ".join(f"v{rng.randrange(10**5)}" for _ in range(150_000))
ROWS = [(1, f"before {PASSAGE} after"), (2, LONG), (3, "x y " * 300_000), (4, LONG + " edited")]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG) > 2_000_000
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_words(docs):
    got = {r.doc_id: r for r in compression_bands(docs).collect()}
    for d, text in ROWS:
        words = text.split(" ")
        words = [w for w in words if w]
        assert (got[d].n_words, got[d].word_chars, got[d].n_symbols) == (len(words), sum(map(len, words)), 0)
    assert got[3].n_repeat_words == 600_000 and got[3].base_failed and not got[2].base_failed


def test_phrases(docs):
    got = {r.doc_id: r for r in phrase_dedup(docs).collect()}
    n = len(LONG.split())
    assert {d: (r.n_words, r.n_removed) for d, r in got.items()} == {1: (122, 0), 2: (n, 120), 3: (600_000, 0), 4: (n + 1, n)}
    assert got[2].kept_sha256 == hashlib.sha256(LONG.replace(PASSAGE + " ", "").encode()).hexdigest()
    assert got[4].kept_sha256 == hashlib.sha256(b"edited").hexdigest()


def test_bytes(docs):
    got = {r.doc_id: r for r in suffix_dedup(docs).collect()}
    assert (got[3].n_removed, got[3].n_spans) == (1_200_000, 1)
    assert got[2].n_removed == len(LONG) and got[4].n_removed == len(LONG)
    assert got[1].n_removed == len(f" {PASSAGE} ")


def test_near_copies(docs):
    found = {r.doc_id: r.component for r in near_components(docs).collect()}
    assert found[2] == found[4] and len({found[1], found[2], found[3]}) == 3


def test_tokens(docs):
    some = docs.where("doc_id in (1, 2)")
    coder = Tokenizer.from_file(str(path("word_bpe_49k.json")))
    coder.no_truncation()
    coder.no_padding()
    for r in bpe_encode(some, path("word_bpe_49k.json")).collect():
        ids = coder.encode(dict(ROWS)[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids


def test_pieces(docs):
    some = docs.where("doc_id in (1, 2)")
    coder = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    coder.no_truncation()
    coder.no_padding()
    pieces = {}
    for r in pack(some, path("byte_bpe_50k.json")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for d, found in pieces.items():
        ids = [*coder.encode(dict(ROWS)[d], add_special_tokens=False).ids, 0]
        at = 0
        for start, length, crc, n in sorted(found):
            assert start == at and n == len(ids)
            assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + length]))
            at += length
        assert at == len(ids)
