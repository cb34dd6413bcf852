import hashlib
import random
import re
from collections import Counter

import numpy as np

from corpusloom.llm import suffix_radix
from corpusloom.llm.suffix_radix import digits, op9_suffix_radix, ordered, remove_repeats, suffix_dedup
from corpusloom.llm.windows import BYTES, WORDS, alone

from .conftest import DATA


def brute(rows, length):
    seen = Counter()
    raws = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raws:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raws:
        gone = [False] * len(b)
        end = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                for j in range(max(i, end), i + length):
                    gone[j] = True
                end = i + length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted(map(tuple, op9_suffix_radix(spark, DATA).collect()), key=str)
    assert got == brute(rows, 400)
    assert any(x[2] for x in got)


def test_small_alphabets_periods_and_odd_rows(spark):
    rng = random.Random(6)
    rows = [(None, None), (1, ""), (2, "short"), (3, "a" * 100), (4, "ab" * 40), (5, "abc" * 7), (6, "x" * 20), (7, "é" * 30), (9, "same text that is long enough to be cut"), (9, "same text that is long enough to be cut"), (9, "other"), (None, "null id null id null id null id 123456")]
    common = "".join(rng.choice("abcd") for _ in range(60))
    for i in range(60):
        body = "".join(rng.choice("ab" if i % 2 else "abcdefg") for _ in range(rng.randint(0, 80)))
        a, b = sorted((rng.randint(0, 60), rng.randint(0, 60)))
        rows.append((100 + i, body[:30] + common[a:b] + body[30:]))
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, tag string, digit int").repartition(5)
    got = sorted(map(tuple, suffix_dedup(df, length=16, gram=4).collect()), key=str)
    assert got == brute(rows, 16)
    assert sorted(map(tuple, suffix_dedup(df, length=16, gram=4, many=3).collect()), key=str) == got
    assert suffix_dedup(df.limit(0), length=16, gram=4).count() == 0


def test_passes_order_and_group_the_suffixes():
    rng = random.Random(3)
    for unit, length in ((BYTES, 12), (BYTES, 5), (WORDS, 3), (WORDS, 7)):
        bodies = [b" ".join(rng.choice([b"a", b"b", b"cc"]) for _ in range(rng.randint(1, 40))) for _ in range(12)]
        x, depth, sizes = digits(bodies, unit)
        if depth > length:
            x, depth = x >> np.uint64(8 * (depth - length)), length
        tokens = [list(b) if unit == BYTES else b.split(b" ") for b in bodies]
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(bodies)), sizes)
        at, group = ordered(x, depth, ends[owner] - np.arange(len(owner)), np.zeros(len(owner), bool), length)
        windows = {int(ends[i] - sizes[i]) + j: tuple(t[j : j + length]) for i, t in enumerate(tokens) for j in range(len(t) - length + 1)}
        seen = Counter(windows.values())
        assert sorted(at.tolist()) == [p for p, w in sorted(windows.items()) if seen[w] > 1]
        told = [windows[p] for p in at.tolist()]
        assert told == sorted(told)
        assert [a == b for a, b in zip(told, told[1:])] == (np.diff(group) == 0).tolist()


def test_nothing_goes_without_the_passes(spark, monkeypatch):
    monkeypatch.setattr(suffix_radix, "radix", lambda unit, length: lambda lot, told: alone(lot, []))
    assert op9_suffix_radix(spark, DATA).where("n_removed > 0").count() == 0


def without_later(rows, length):
    """Of (order, text): the text without words in windows that begin earlier too."""
    first = {}
    for d, t in sorted(rows):
        words = t.split()
        for i in range(len(words) - length + 1):
            first.setdefault(tuple(words[i : i + length]), (d, i))
    out = {}
    for d, t in rows:
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        said = t.split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first[tuple(said[i : i + length])] < (d, i):
                gone[i : i + length] = [True] * length
        stop = ([a for a, _ in words[1:]] + [len(t)])[: len(words)]
        cut = {k for (a, _), b, g in zip(words, stop, gone, strict=True) if g for k in range(a, b)}
        out[d] = "".join(c for k, c in enumerate(t) if k not in cut)
    return out


def test_stage_keeps_the_first_place(spark):
    rng = random.Random(4)
    common = [rng.choice("abcdé") + rng.choice("xyz") for _ in range(24)]
    rows = [(5, ""), (6, " \t \n"), (7, " ".join(common)), (8, "a " * 40), (9, "a " * 30), (4, "a " * 9 + "b")]
    for i in range(120):
        a, b = sorted((rng.randint(0, 24), rng.randint(0, 24)))
        body = [rng.choice(["p", "q"] if i % 3 else ["r", "s", "t", "u", "v"]) for _ in range(rng.randint(0, 30))]
        rows.append((10 + i, rng.choice([" ", "\n", "  "]).join(body[:12] + common[a:b] + body[12:])))
    want = without_later(rows, 8)
    assert want != dict(rows)
    df = spark.createDataFrame([(*r, "x", len(r[1])) for r in rows], "doc_id long, text string, digit string, n_chars int").repartition(4)
    for many in (4096, 3):
        got = remove_repeats(df, length=8, gram=3, many=many).collect()
        assert {r.doc_id: r.text for r in got} == want
        assert all(r.n_chars == len(r.text) and r.digit == "x" for r in got)


def test_stage_over_the_documents(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    want = without_later(rows, 50)
    assert want != dict(rows)
    assert {r.doc_id: r.text or "" for r in remove_repeats(df).collect()} == want


def test_stage_keeps_columns(spark):
    words = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "new " + words, "en", 0), (2, words, "de", 0), (3, None, "fr", None), (None, words, "es", 5), (4, "short", "en", 5), (4, "short", "en", 5)], "doc_id long, text string, key string, n_chars long")
    got = sorted(map(tuple, remove_repeats(df.withColumn("_spans", df.key).withColumn("_key", df.n_chars)).collect()), key=str)
    assert got == sorted([(1, "new " + words, "en", 0, "en", 0), (2, "", "de", 0, "de", 0), (3, None, "fr", None, "fr", None), (None, "", "es", 0, "es", 5), (4, "short", "en", 5, "en", 5), (4, "short", "en", 5, "en", 5)], key=str)
    raw = spark.createDataFrame([(1, "0123456789abcdefXYZ", "en"), (2, "0123456789abcdef", "de")], "doc_id long, text string, lang string")
    assert sorted(map(tuple, remove_repeats(raw, unit=BYTES, length=16, gram=4).collect())) == [(1, "0123456789abcdefXYZ", "en"), (2, "", "de")]
