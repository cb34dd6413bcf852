import zlib

import numpy as np

from corpusloom.llm.toxicity_mil import Model, fit, op2_toxicity_mil, sentences, slots, toxicity, train


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op2_toxicity_mil(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in test) / len(test) > 0.93
    good, bad = ([r.score for r in rows if r.held_out and labels.get(r.doc_id) == y] for y in (0, 1))
    assert bad and sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good)) > 0.95


def test_noisy_or_finds_the_sentence():
    rng = np.random.default_rng(0)
    words = [f"wort{i}" for i in range(40)]
    bags, labels = [], []
    for i in range(400):
        text = [[words[k] for k in rng.integers(0, 40, 6)] for _ in range(5)]
        if i % 4 == 0:
            text[i % 5][2] = "vile"
        labels.append(int(i % 4 == 0))
        bags.append([np.array([x for w in s for x in slots(w)]) for s in text])
    m = fit(bags, np.array(labels), np.ones(400))
    p, bad = m.score("wort1 wort2. wort3 vile wort4! wort5\nwort6")
    assert p > 0.9
    assert [(a, b) for a, b, _ in bad] == [(13, 30)]
    assert m.score("wort1 wort2. wort3") [0] < 0.1
    assert m.score("")[0] == 0


def test_one_class_nulls_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x y.", "c"), (3, "x", "d"), (3, "x", "e")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 0), (99, 0)], "doc_id long, toxic int")
    m = train(docs, labels)
    got = toxicity(docs, m).collect()
    assert len(got) == 5 and all(r.predicted == 0 for r in got)
    assert train(docs, labels.limit(0)).weights.sum() == 0
    assert toxicity(docs.limit(0), Model(np.zeros(1 << 18), -7.0)).count() == 0
    assert sentences("A b! c\n. D") == [["a", "b"], ["c"], ["d"]]


def test_clashing_columns_ties_and_very_long_texts(spark):
    long = "other text. " * 150_000
    docs = spark.createDataFrame([(i, "vile wort. gut" if i % 3 == 0 else "wort gut. eins", 1, 2, 3) for i in range(60)] + [(90, long, 1, 2, 3), (91, long + "vile wort.", 1, 2, 3)], "doc_id long, text string, _id int, _toxic int, _h int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(60)] + [(90, 0, "x")], "doc_id long, toxic int, _id string")
    m = train(docs, labels)
    got = {r.doc_id: r.predicted for r in toxicity(docs, m).collect()}
    assert got == {**{i: int(i % 3 == 0) for i in range(60)}, 90: 0, 91: 1}
    few = train(docs, labels, sample_bytes=200)  # the long text is no part of it
    assert few.score("wort vile")[0] > few.score("wort gut")[0]
    level = Model(np.zeros(1 << 18), 0.0)  # one sentence at even odds
    assert [(r.score, r.predicted) for r in toxicity(docs.where("doc_id = 60 or doc_id = 1").limit(1), level).collect()] == [(0.75, 1)]
