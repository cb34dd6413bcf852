"""Every query with SQL against DuckDB, on the smallest tables."""

import datetime
import difflib
import os
import re
import unicodedata

import duckdb
import numpy as np
import pytest

from corpusloom.functions import similarity as S
from corpusloom.operators import agreement
from corpusloom.queries import ORACLES, QUERIES, records

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    found = duck.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()), key=str)
    assert got == want


def lcs(a, b):
    """The plain table, a row at a time."""
    x, y = (np.array([ord(c) for c in t], np.int64) for t in (a, b))
    row = np.zeros(len(y) + 1, np.int64)
    for c in x:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == c)))
    return int(row[-1])


def indel(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def bodies(duck):
    """Different normalised bodies of each first line that several documents share."""
    groups = {}
    for i, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        title, _, body = (text or "").partition("\n")
        if title.strip():
            body = re.sub(r"\s+([.,;:!?])", r"\1", re.sub(r"\s+", " ", unicodedata.normalize("NFKC", body).lower().strip()))
            groups.setdefault(title, []).append(body)
    return {t: list(dict.fromkeys(b)) for t, b in groups.items() if len(b) > 1}


def test_fuzzy_groups(spark, duck):
    want = {}
    for title, kinds in bodies(duck).items():
        scores = [indel(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :]]
        want[title] = (min(scores, default=100), max(scores, default=100), len(scores), all(s >= 90 for s in scores))
    got = {r.title: (r.least, r.greatest, r.pairs, r.passed) for r in agreement.pair_scores(records.shared_bodies(spark, DATA), "title", "body").collect()}
    assert got.keys() == want.keys() and any(x[2] == 0 for x in want.values())
    for t, w in want.items():
        assert got[t] == (pytest.approx(w[0]), pytest.approx(w[1]), *w[2:])
    rate = QUERIES["fuzzy_pass_rate"](spark, DATA).first()
    assert (rate.groups, rate.passed) == (len(want), sum(x[3] for x in want.values()))


def test_fuzzy_pairs(spark, duck):
    """Each paper against all others of its title in plain Python."""
    groups = {}
    for i, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        title, _, body = (text or "").partition("\n")
        if title.strip(" "):
            body = re.sub(r"\s+([.,;:!?])", r"\1", re.sub(r"\s+", " ", unicodedata.normalize("NFKC", body).lower().strip()))
            groups.setdefault(title, []).append((i, body))
    want = {}
    for own in (x for x in groups.values() if len(x) > 1):
        like = {i: [j for j, u in own if j != i and indel(t, u) >= 90] for i, t in own}
        for i, _ in own:
            reached, todo = {i}, [i]
            while todo:
                todo += [j for j in like[todo.pop()] if j not in reached and not reached.add(j)]
            want[i] = (own[0][0], min(reached), len(like[i]), all(len(x) == len(own) - 1 for x in like.values()))
    got = QUERIES["fuzzy_pairs"](spark, DATA).collect()
    assert len(got) == len(want) and {r.doc_id: (r.group_id, r.class_id, r.links, r.passed) for r in got} == want
    assert {0} < {x[2] for x in want.values()}


def windows(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    return max(S.indel(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def test_title_pairs(spark, duck):
    """Different first lines over one body, each pair against plain Python."""
    over = {}
    for i, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        title, _, body = (text or "").partition("\n")
        title = " ".join(re.sub(r"[^\w\s]", " ", title.lower()).split()) or None
        if body.strip(" "):
            over.setdefault(body, {}).setdefault(title, i)
    want, match = {}, {}
    for titles in over.values():
        known = sorted((i, t) for t, i in titles.items())
        for k, (i, a) in enumerate(known):
            for j, b in known[k + 1 :]:
                none = a is None or b is None
                partial = None if none else windows(a, b)
                want[i, j] = (not none and (S.indel(a, b) >= 90 or partial >= 90), partial)
                match[i, j] = None if none else difflib.SequenceMatcher(None, a, b).ratio() >= 0.9
    got = {(r.doc_id_1, r.doc_id_2): (r.agree, r.partial) for r in QUERIES["title_partial"](spark, DATA).collect()}
    assert want and got.keys() == want.keys()
    for k, (agree, partial) in want.items():
        assert got[k] == (agree, partial if partial is None else pytest.approx(partial))
    assert {(r.doc_id_1, r.doc_id_2): r.match for r in QUERIES["seqmatch_pairs"](spark, DATA).collect()} == match


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert all(len(r) == len(df.columns) for r in df.collect())


def test_sequences_agree_as_their_ratio(spark):
    """Bounds before SequenceMatcher change no verdict, and what they settle doesn't reach it."""
    rng = np.random.default_rng(3)
    rows = [("", ""), ("", "a"), (None, "a"), ("abcdefghij", "jihgfedcba"), ("ab" * 200, "ba" * 200)]
    for n in (9, 10, 11, 40, 300):
        for edits in (0, 1, n // 20, n // 10, n // 5):
            a = "".join(rng.choice([*"abcd "], n))
            rows += [(a, "".join(c if rng.random() * n > edits else "x" for c in a)), (a, a[edits:]), (a, a[: n - edits] + a[:edits])]
    df = spark.createDataFrame(rows, "a string, b string")
    want = [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() >= 0.9 for a, b in rows]
    assert {True, False} < {*want}
    assert [r.m for r in df.select(S.sequences_agree(df.a, df.b).alias("m")).collect()] == want
    long = "".join(rng.choice([*"abcdefgh"], 20_000))
    assert not S.sequence_reaches(long, "".join(rng.choice([*"ijklmnop"], 20_000)), 0.9)


def test_pairs_of_a_large_group_are_dealt_out(spark):
    from corpusloom.operators import joins

    rows = [("g", i, f"t{i}") for i in range(150)] + [("h", i, f"u{i}") for i in range(3)] + [("one", 1, "x"), (None, 1, "y"), (None, 2, "z")]
    df = spark.createDataFrame(rows, "k string, i long, t string").repartition(3)
    pairs = joins.pairs_in_blocks(df, "k", "i", "t", block=8)
    key = lambda frame: sorted(map(tuple, frame.select("k", "i_1", "t_1", "i_2", "t_2").collect()))
    assert key(pairs) == key(joins.pairs_within(df, "k", "i", "t")) and pairs.count() == 150 * 149 // 2 + 3
    from pyspark.sql import functions as F

    sizes = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.1 * pairs.count()
