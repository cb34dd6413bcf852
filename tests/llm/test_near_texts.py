import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import near_texts
from corpusloom.llm.near_texts import near_components

from .conftest import DATA
from .test_simhash_covering import plain_components

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def plain_shingles(text):
    words = text.encode("utf-8", "replace").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(a, b):
    return 10 * len(a & b) >= 8 * len(a | b)


def components_of(texts):
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    return plain_components(sorted(texts), lambda a, b: near(sets[a], sets[b]))


def edited(rng, words, n):
    words = [*words]
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10**6)}"
    return words


def made():
    """Groups of edited copies at all similarities around 0.8, over a common passage, with one large group."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    texts = {}
    for g in range(40):
        base = common + [f"w{rng.randrange(3000)}" for _ in range(rng.choice([5, 60, 200]))]
        for n in (0, 0, 1, 2, 3, 4, 5, 6, 7):
            texts[len(texts)] = " ".join(edited(rng, base, n))
    big = [f"b{i}" for i in range(150)]
    for _ in range(60):
        texts[len(texts)] = " ".join(edited(rng, big, rng.choice([1, 2])))
    return texts | {1000: "", 1001: " ", 1002: "one two", 1003: "One  two", 1004: "one two three"}


def test_components_are_those_of_all_pairs(spark):
    texts = made()
    want = components_of(texts)
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(5)
    for options in ({}, {"few": 2, "block": 8}):
        got = {}
        for r in near_components(df, **options).collect():
            got.setdefault(r.component, set()).add(r.doc_id)
        assert {d: min(c) for c in got.values() for d in c} == want
    assert near_components(df.limit(0)).count() == 0


def test_sets_that_share_a_number_are_told_apart(spark):
    """With three bits for a number nearly all sets clash, and the components are the same."""
    texts = made()
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(5)
    parts = lambda **o: {frozenset(r.ids) for r in near_components(df, **o).groupBy("component").agg(F.collect_set("doc_id").alias("ids")).collect()}
    assert parts(bits=3) == parts()


def test_stage_finds_every_pair_at_08(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    want = components_of(texts)
    assert any(near(plain_shingles(texts[a]), plain_shingles(texts[b])) and texts[a] != texts[b] for a, b in itertools.combinations(texts, 2))
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, DATA).collect()} == {d for d, c in want.items() if c == d}


def test_one_row_of_each_component(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "k"), (1, a, "k"), (1, a.upper(), "l"), (2, a, "k"), (None, a, "k"), (1, b, "k"), (None, c, "k"), (None, c, "k"), (None, c + " more", "l"), (None, None, "k"), (None, "", "k"), (3, " ", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    got = [(r.doc_id, r.text, r.key) for r in corpus_pipeline.near_dedup(spark, df, DATA).collect()]
    assert len(got) == 4
    assert sum((t or "").lower() == a and d == 1 for d, t, _ in got) == 1
    assert (1, b, "k") in got and (3, " ", None) in got
    assert sum(d is None and (t or "").startswith(c) for d, t, _ in got) == 1
    again = [(r.doc_id, r.text, r.key) for r in corpus_pipeline.near_dedup(spark, df.repartition(7), DATA).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)
    once = spark.createDataFrame([(7, a, "k"), (7, a, "k")], df.schema)
    left = corpus_pipeline.substring_dedup(spark, corpus_pipeline.near_dedup(spark, once, DATA), DATA).collect()
    assert [r.text for r in left] == [a]


def test_simhash_gives_close_pairs(spark):
    texts = made()
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    rows = near_texts._keyed(spark.createDataFrame([*texts.items()], "doc_id long, text string"), "doc_id", "text").toDF("doc_id", "text", "key", "tag").select("doc_id", "key", "tag", "text")
    classes = near_texts.map_batches(rows, near_texts._classes(64), "doc_id long, key long, tag long, cls long, wide long, fp long").cache()
    doc = {r.cls: r.doc_id for r in classes.collect()}
    found = {(doc[r.a], doc[r.b]) for r in near_texts.close_pairs(classes).collect()}
    assert sum(near(sets[a], sets[b]) for a, b in found) > 50
    fp = {r.doc_id: r.fp for r in classes.collect()}
    assert all(((fp[a] ^ fp[b]) & (1 << 64) - 1).bit_count() <= 4 for a, b in found)


def test_no_side_of_a_join_is_broadcast(spark, monkeypatch):
    """All sides here lie below Spark's threshold, but they grow with the input and would meet in the driver."""
    plans, real = [], near_texts.cut

    def cut(df):
        made = real(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(near_texts, "cut", cut)
    df = near_texts.drop_near_texts(spark.createDataFrame([*made().items()], "doc_id long, text string").repartition(5))
    assert df.count() > 100
    df.collect()
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) > 5 and not [p for p in plans if "BroadcastExchange" in p]


def test_pairs_within_the_radius_come_from_simhash_alone(spark, monkeypatch):
    """Every pair has one source: without SimHash's, just the pairs within its radius are missing."""
    texts = made()
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(5)
    fp = {d: near_texts.simhash_covering.majority(x) if len(x := near_texts.shingles(t)) else 0 for d, t in texts.items()}
    beyond = plain_components(sorted(texts), lambda a, b: sets[a] == sets[b] or near(sets[a], sets[b]) and (fp[a] ^ fp[b]).bit_count() > 4)
    assert beyond != components_of(texts)
    monkeypatch.setattr(near_texts, "close_members", lambda classes, real=near_texts.close_members: real(classes).limit(0))
    for options in ({}, {"few": 2, "block": 8}):
        got = {}
        for r in near_components(df, **options).collect():
            got.setdefault(r.component, set()).add(r.doc_id)
        assert {d: min(c) for c in got.values() for d in c} == beyond
