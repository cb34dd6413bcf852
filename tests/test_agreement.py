import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import similarity as S
from corpusloom.operators import agreement


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = (last + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def indel(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def windows(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    return max(indel(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def text(rng, letters, most):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(most)))


def changed(rng, t, edits):
    t = list(t)
    for _ in range(edits):
        i = rng.randrange(len(t) + 1)
        t[i : i + rng.randrange(2)] = rng.choice([[], [rng.choice("xyz")]])
    return "".join(t)


def test_similarities_equal_plain_ones():
    rng = random.Random(1)
    for _ in range(600):
        letters = rng.choice(["ab", "abc", "aé😀b c"])
        a, b = text(rng, letters, 14), text(rng, letters, 22)
        assert S.lcs(a, b) == lcs(a, b)
        assert S.best_window(a, b) == pytest.approx(windows(a, b))
        within = S.distance_within(a, b, 90.0)
        assert within == (len(a) + len(b) - 2 * lcs(a, b) if indel(a, b) >= 90 else None)
    a = text(rng, "abcdefgh ", 900) * 2
    b = changed(rng, a, 80)
    assert S.lcs(a, b) == lcs(a, b)


def test_every_window_in_one_sweep():
    rng = random.Random(2)
    for _ in range(300):
        b = text(rng, "abc", 20) + "a"
        a = text(rng, "abc", len(b)) + "b"
        n = len(a)
        whole, heads, tails = S.window_lcs(a, b)
        assert whole.tolist() == [lcs(a, b[i : i + n]) for i in range(len(b) - n + 1)]
        assert heads.tolist() == [lcs(a, b[:k]) for k in range(1, n)] and tails.tolist() == [lcs(a, b[-k:]) for k in range(1, n)]


@pytest.mark.parametrize("small", [False, True])
def test_pairs_are_swept_together(monkeypatch, small):
    """Pairs of all lengths as each alone, in few sweeps; with small limits long strings are cut, and numbers have 32 bits."""
    if small:
        for name, value in {"WIDTH": 50, "PIECES": 2, "PIECE": 3, "NARROW": 90, "STEP": (1.1, 1.5), "HELD": 300}.items():
            monkeypatch.setattr(S, name, value)
    rng = random.Random(3)
    pairs = [("", ""), ("", "ab"), ("ab", "a"), ("abcdefghij", "abcdefghi"), ("abcdefghij", "abcdXefghi")]
    for _ in range(150):
        letters = rng.choice(["ab", "abcd ", "aé😀b c"])
        a = text(rng, letters, rng.choice([4, 25]))
        pairs.append(rng.choice([(a, text(rng, letters, 90)), (text(rng, letters, 90), a), (a, changed(rng, a, 2))]))
    swept = []
    one = S.strands
    monkeypatch.setattr(S, "strands", lambda lanes, letters: swept.append(len(lanes)) or one(lanes, letters))
    best, agree = S.best_windows(pairs)
    assert len(swept) < len(pairs) // (2 if small else 10)
    assert best.tolist() == pytest.approx([windows(a, b) for a, b in pairs])
    assert agree.tolist() == [windows(a, b) >= 90 or indel(a, b) >= 90 for a, b in pairs]
    assert {True, False} == {*agree.tolist()}


def test_title_scores_with_nulls(spark):
    rows = [("poly", "copolymers"), (None, "x"), ("x", None), (None, None), ("", ""), ("", "a"), ("abcdefghij", "jihgfedcba")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    got = [tuple(r.s) for r in df.select(S.title_scores(df.a, df.b).alias("s")).collect()]
    assert got == [tuple(r) for r in df.select(S.partial_ratio(df.a, df.b), S.titles_agree(df.a, df.b)).collect()]
    assert [x[0] for x in got[:6]] == [100.0, None, None, None, 100.0, 0.0]


def groups(seed):
    rng = random.Random(seed)
    out = {}
    for g in range(60):
        base = text(rng, "abcdefgh ", 120) + "tail of it"
        size = rng.choice([1, 2, 3, 8])
        out[f"g{g}"] = [changed(rng, base, rng.choice([0, 1, 2, len(base) // 12])) for _ in range(size)] + rng.choice([[], [None], ["", None], [base]])
    out["far"] = ["a" * 100 + "b" * k + "c" * (9 - k) for k in range(10)]  # near a middle one, but not each other
    out["line"] = ["a" * k for k in range(100, 121)]
    return out


@pytest.mark.parametrize("rounds,block", [(8, 128), (1, 2), (2, 3)])
def test_groups_equal_all_pairs(spark, rounds, block):
    known = groups(rounds)
    df = spark.createDataFrame([(g, t, 1) for g, ts in known.items() for t in ts] + [(None, "x", 1)], "title string, body string, pairs int")
    want = {}
    for g, ts in known.items():
        kinds = list(dict.fromkeys(t or "" for t in ts))
        want[g] = (len(kinds), [indel(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :]])
    got = {r.title: (r.kinds, r.passed) for r in agreement.all_agree(df, "title", "body", rounds=rounds, block=block).collect()}
    assert got == {g: (k, all(s >= 90 for s in scores)) for g, (k, scores) in want.items()}
    assert 5 < sum(p for _, p in got.values()) < len(got) - 5
    scored = {r.title: r for r in agreement.pair_scores(df, "title", "body", block=block).collect()}
    for g, (_, scores) in want.items():
        r = scored[g]
        assert (r.pairs, r.passed) == (len(scores), all(s >= 90 for s in scores))
        assert (r.least, r.greatest, r["mean"]) == pytest.approx((min(scores, default=100), max(scores, default=100), sum(scores) / len(scores) if scores else 100))
    none = df.limit(0)
    assert agreement.all_agree(none, "title", "body").collect() == [] and agreement.pair_scores(none, "title", "body").collect() == []


def test_title_of_ten_thousand_bodies(spark):
    """Linear in the bodies: all near one, one pair of them too far apart, and all different."""
    n = 10_000
    word = lambda c: F.sha2(c.cast("string"), 256)
    base = "".join(f"{i * 7919 % 1000:03d} " for i in range(60))
    near = spark.range(n).select(F.lit("near").alias("t"), F.concat(F.lit(base), F.substring(word(F.col("id")), 1, 5)).alias("b"))
    far = near.select(F.lit("far").alias("t"), "b").union(spark.createDataFrame([("far", base[16:] + "00000"), ("far", base[:-28])], "t string, b string"))
    other = spark.range(n).select(F.lit("other").alias("t"), F.concat(*(word(F.col("id") * 5 + i) for i in range(4))).alias("b"))
    began = time.time()
    got = {r.t: (r.kinds, r.passed) for r in agreement.all_agree(near.union(far).union(other), "t", "b").collect()}
    kinds = near.distinct().count()
    assert indel(base[16:] + "00000", base[:-28]) < 90 <= min(indel(base + "12345", base[16:] + "00000"), indel(base + "12345", base[:-28]))
    assert got == {"near": (kinds, True), "far": (kinds + 2, False), "other": (n, False)}
    assert time.time() - began < 120
