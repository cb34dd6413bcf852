import itertools
import os
import random
import re

import duckdb
import pytest

from corpusloom.llm.filter_audit import ORACLE, filter_audit, op12_filter_audit, word_totals

from .conftest import DATA

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied to the documents one filter after another."""
    texts = {}
    for doc, _, text in docs:
        if doc is not None:
            texts.setdefault(text or "", set()).add(doc)
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))

    def failed(doc, text):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        a, b = len(words) < 50, 100 * len(set(words)) < 65 * len(words)
        c, d = 100 * sum("A" <= x <= "Z" for x in text) > 5 * len(text), any(x in "#$%&*|" for x in text)
        e = doc is not None and any(x < doc for x in texts.get(text, ()))
        return {f for f, x in zip("ABCDE", (a, b, c, d, e), strict=True) if x}

    parts = {}
    for doc, part, text in docs:
        parts.setdefault(part or "", []).append((doc, failed(doc, text or "")))
    out, removed_by = [], {}
    for part, rows in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                fails = [x for _, x in rows if f in x]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), len(fails) - len(gone), sum(x == {f} for x in fails), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


@pytest.mark.parametrize("sf_dir", [DATA, DATA.replace("0.001", "0.01")])
def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    got = op12_filter_audit(spark, sf_dir)
    found = con.execute(ORACLE)
    assert [x[0] for x in found.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())


def documents(n, seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a " * 60, "A" * 30, "#", " ".join(map(str, range(70))), " ".join(map(str, range(80))) + " X" * 9 + "|", "w v " * 3, "😀 Q"]
    texts = [t.encode("utf-16", "surrogatepass").decode("utf-16") if t else t for t in texts]
    rows = [(rng.choice([None, *range(20)]), rng.choice([None, "", "s", "t"]), rng.choice(texts)) for _ in range(n)]
    return rows + rows[:5]


def test_equals_brute_force(spark):
    docs = documents(120, 1)
    labels = [(i, q, t) for i in [None, *range(12), 3, 3, 99] for q, t in [((i or 0) % 3 - 1 or None, (i or 0) % 2)]] + [(4, 1, None), (4, 0, 1)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, source string, text string, part string, n int")
    marks = spark.createDataFrame([(*m, "y") for m in labels], f"{LABELS}, good string")
    got = filter_audit(df, marks)
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)
    assert {t for _, t in got.dtypes} == {"string", "int", "bigint"}


def test_many_copies_over_parts(spark):
    docs = [(i, f"s{i % 3}", "same text") for i in range(3000)] + [(i, "s1", f"{i} text") for i in range(3000, 3300)]
    got = filter_audit(spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(7), spark.createDataFrame([(5, 1, 1)], LABELS))
    assert sorted(map(tuple, got.collect())) == brute(docs, [(5, 1, 1)])


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "s", "t")], "doc_id long, source string, text string"), spark.createDataFrame([], LABELS)
    assert filter_audit(docs.limit(0), none).collect() == []
    assert sorted(map(tuple, filter_audit(docs, none).collect())) == brute([(1, "s", "t")], [])


def test_long_text_and_words_are_not_shuffled(spark):
    """A text of megabytes; both counts of words need no exchange but the one that deals out texts."""
    rows = spark.createDataFrame([(b"1", "a b " * 500_000), (b"2", ""), (b"3", " x"), (b"3", " x")], "key binary, text string")
    df = word_totals(rows)
    assert {bytes(r.key): (r.n_words, r.n_distinct) for r in df.collect()} == {b"1": (1_000_000, 2), b"2": (0, 0), b"3": (1, 1)}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange ") == 1
