import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import periodic_runs as P

from .conftest import DATA


def plain_runs(words):
    """Every stretch of each period that neither neighbour extends, with the smallest period of the stretch."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # ascending q: the smallest stays
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(text, doc):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if doc is not None and n and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def of(texts):
    words = [[w.encode() for w in t] for t in texts]
    return P.batch_runs(*P._numbered(words))


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in P.op11_periodic_runs(spark, DATA).collect()}
    want = {r.doc_id: plain_row(r.text, r.doc_id) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert got == want
    assert sum(x[0] > 0 for x in want.values()) > 10


def test_all_short_texts():
    for size in range(1, 13):
        texts = [[("a", "b")[k >> i & 1] for i in range(size)] for k in range(1 << size)]
        assert of(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=4).flatmap(lambda x: st.integers(1, 14).map(lambda k: x * k)), max_size=12), st.integers(1, 4))
def test_powers_of_phrases(parts, copies):
    text = [w for p in parts for w in p]
    assert of([text] * copies) == [plain_runs(text)] * copies


def test_long_periods_at_any_place():
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        p = rng.choice([1, 2, 3, 7, 11, 12, 13, 31, 64, 100])
        phrase = [str(rng.randrange(50)) for _ in range(p)]
        run = (phrase * 11)[: int(p * rng.uniform(3.8, 10))]
        texts.append([str(rng.randrange(50)) for _ in range(rng.randrange(200))] + run + [str(rng.randrange(50)) for _ in range(rng.randrange(200))])
    assert of(texts) == [plain_runs(t) for t in texts]
    assert sum(map(len, of(texts))) >= 20


def test_z_function():
    rng = random.Random(6)
    for _ in range(200):
        x = [rng.randrange(2) for _ in range(rng.randrange(30))]
        assert P.z_function(x) == [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]


def test_sweep_loses_no_run():
    """With every block let through, nothing more is found."""
    rng = random.Random(7)
    texts = [[rng.choice("ab") for _ in range(rng.randrange(80))] for _ in range(60)]
    before, look = of(texts), P.may_cross
    P.may_cross = lambda words, half, most: np.arange(half, len(words), 2 * half)
    try:
        assert of(texts) == before == [plain_runs(t) for t in texts]
    finally:
        P.may_cross = look


def test_strongest_run():
    assert P.strongest([]) is None
    assert P.strongest([(0, 8, 2), (9, 12, 3)]) == (0, 8, 2)
    assert P.strongest([(0, 8, 2), (9, 13, 3)]) == (9, 13, 3)
    big = 10**17
    assert P.strongest([(0, 4 * big, big), (5, 4 * big + 1, big)]) == (5, 4 * big + 1, big)  # doubles can't tell these apart


def test_long_text(spark):
    """A text of megabytes, of one word but for its middle."""
    text = "a " * 200_000 + "b " + "c d " * 150_000
    row = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 0, 200_000, 1, 200_000_000)
    assert row.collapsed_sha256 == hashlib.sha256(b"a b c d").hexdigest()


def test_edges(spark):
    """Nulls, empty texts, repeated rows, clashing columns, empty tables."""
    text = "x y " * 9
    rows = [(1, None, "p"), (2, "", "q"), (None, text, None), (3, text, "r"), (3, text, "r"), (4, " \t\n", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    got = sorted(map(tuple, P.periodic_runs(docs).collect()), key=str)
    none, one = plain_row("", None), plain_row(text, None)
    assert got == sorted([(1, *none), (2, *none), (4, *none), (None, *one), (3, *one), (3, *one)], key=str)
    assert P.periodic_runs(docs.limit(0)).collect() == []
    null = P.periodic_runs(docs.where("doc_id is null"), plant=True).first()
    assert tuple(null)[1:] == one
