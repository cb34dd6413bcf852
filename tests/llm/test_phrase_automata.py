import hashlib
import random
import re

from corpusloom.llm import phrase_automata
from corpusloom.llm.phrase_automata import op3_phrase_automata, phrase_dedup
from corpusloom.llm.windows import alone

from .conftest import DATA


def brute(rows, window):
    first = {}
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < d:
                    gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted(map(tuple, op3_phrase_automata(spark, DATA).collect()), key=str)
    assert got == brute(rows, 50)
    assert any(x[2] for x in got)


def test_common_phrases_periods_and_odd_rows(spark):
    rng = random.Random(8)
    common = [rng.choice("abcdé") + rng.choice("xyz") for _ in range(24)]
    rows = [(None, None), (5, ""), (6, " \t \n"), (None, " ".join(common)), (7, " ".join(common)), (7, " ".join(common)), (8, "a " * 40), (9, "a " * 30), (4, "a " * 9 + "b")]
    for i in range(120):
        a, b = sorted((rng.randint(0, 24), rng.randint(0, 24)))
        body = [rng.choice(["p", "q"] if i % 3 else ["r", "s", "t", "u", "v"]) for _ in range(rng.randint(0, 30))]
        rows.append((10 + i % 90, rng.choice([" ", "\n", "  "]).join(body[:12] + common[a:b] + body[12:])))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, tag string, phrase int").repartition(4)
    want = brute(rows, 8)
    assert sorted(map(tuple, phrase_dedup(df, window=8, gram=3).collect()), key=str) == want
    assert sorted(map(tuple, phrase_dedup(df, window=8, gram=3, stream=3, shard=5).collect()), key=str) == want
    assert phrase_dedup(df.limit(0), window=8, gram=3).count() == 0


def test_nothing_goes_without_the_automata(spark, monkeypatch):
    monkeypatch.setattr(phrase_automata, "automata", lambda window, shard: lambda lot, told: alone(lot, []))
    assert op3_phrase_automata(spark, DATA).where("n_removed > 0").count() == 0
