import random
import zlib
from collections import defaultdict

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

from corpusloom.llm.packing_dp import cut_points, op10_packing_dp, pack, word_ids

from .conftest import DATA

FILE = path("byte_bpe_50k.json")
HARD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "a\n b", "a\n  b", "\n\n", "a <|endoftext|> b", "a  <|endoftext|>b", "x y  z", "'s it's", "é ß  \t", "a\t b \tc", "<|endoftext|>", " . . ."]


def test_ids_equal_the_library():
    tok = Tokenizer.from_file(FILE)
    rng = random.Random(1)
    some = HARD + ["".join(rng.choice("abst .,\n\t'1é! ") for _ in range(40)) for _ in range(300)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in word_ids(FILE).encode(some)]
        assert got == [e.ids for e in tok.encode_batch(some, add_special_tokens=False)]


def cost(points, n, penalty, size, short):
    total, before = 0, 0
    for p in points:
        k = p - before
        assert 0 < k <= size
        total += (short if k & (k - 1) == 0 else 1) * (size - k) + penalty(p)
        before = p
    return total


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        n, size = rng.randint(1, 60), 16
        docs = sorted({n, *rng.sample(range(1, n + 1), min(n, 3))})
        sents = sorted(set(rng.sample(range(1, n + 1), min(n, 8))))
        fit, short = rng.choice([0, 3, 9]), rng.choice([0, 0.5, 1])

        def penalty(p, n=n, docs=docs, sents=sents, fit=fit, size=size):
            if p in docs or p == n:
                return 0
            begin, end = max([0, *(d for d in docs if d < p)]), min(d for d in docs if d > p)
            return (2 if p in sents else 5) + fit * (end - begin <= size)

        best = [0.0] + [1e9] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - size), j):
                k = j - i
                best[j] = min(best[j], best[i] + (short if k & (k - 1) == 0 else 1) * (size - k) + penalty(j))
        got = cut_points(n, np.array(docs), np.array(sents), size, 2, 5, 1, fit, short)
        assert got[-1] == n
        assert cost(got.tolist(), n, penalty, size, short) == best[n]


def test_very_long_text_without_sentences(spark):
    df = spark.createDataFrame([(1, "word " * 60_000), (2, "x")], "doc_id long, text string").coalesce(1)
    sizes = defaultdict(int)
    for r in pack(df, FILE).collect():
        sizes[r.sequence_id] += r.length
    assert sorted(sizes.values())[1:] == [1024] * (len(sizes) - 1)


def test_query_packs_each_id_once(spark):
    tok = Tokenizer.from_file(FILE)
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    ids = {d: [*e.ids, 0] for d, e in zip(rows, tok.encode_batch(list(rows.values()), add_special_tokens=False), strict=True)}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in op10_packing_dp(spark, DATA).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for d, x in by_doc.items():
        assert sum(n for _, n in x) == len(ids[d])
    padding = short = 0
    for x in by_seq.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        short += at <= 256
    tokens = sum(map(len, ids.values()))
    assert padding < 0.02 * tokens, padding / tokens
    assert short <= 8 and len(by_seq) < 1.05 * tokens / 1024 + 8


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "a", 6), (1, None, 5)], "doc_id long, text string, start int").coalesce(1)
    got = [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in pack(df, FILE).collect()]
    assert got == [(1, 0, 1, 1, 0), (None, 0, 2, 2, 0), (1, 0, 1, 1, 0)] or sum(x[2] for x in got) == 4
    assert pack(df.limit(0), FILE).count() == 0
    assert [list(r.ids) for r in pack(df.limit(1), FILE, with_ids=True).collect()] == [[0]]
