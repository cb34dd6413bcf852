import itertools
import random

import pytest
import xxhash

from corpusloom.llm.common import components, shared_base
from corpusloom.llm.simhash_covering import covering_masks, near_links, op6_simhash_covering, simhash_components

from .conftest import DATA


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(nodes, near):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {x: root(x) for x in nodes}


def test_masks_cover_every_difference():
    rng = random.Random(3)
    masks = covering_masks()
    assert len(masks) == 31
    for _ in range(20000):
        diff = sum(1 << i for i in rng.sample(range(64), 4))
        assert any(not diff & m for m in masks)


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    fp = {d: plain_fingerprint(t) for d, t in rows.items()}
    want = plain_components(sorted(rows), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash_covering(spark, DATA).collect()}
    assert got == {d: (f"{fp[d]:016x}", want[d]) for d in rows}
    assert len({*want.values()}) < len(rows)


def test_large_buckets_in_blocks(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 300:
        x = rng.choice([*fps])
        fps.add(x ^ sum(1 << i for i in rng.sample(range(64), rng.choice([1, 4, 5, 6]))))
    fps = sorted(fps)
    want = plain_components(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "rep long, fp long")
    got = {r.node: r.component for r in components(near_links(df, block=16)).collect()}
    assert {i: got.get(i, i) for i in range(len(fps))} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(500)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (2001, 2000), (2000, 2001)]
    df = spark.createDataFrame(chain, "a long, b long").repartition(7)
    for options in ({}, {"few": 0}, {"few": 0, "hot": 3}):
        got = {r.node: r.component for r in components(df, **options).collect()}
        assert got == {**{i: 0 for i in range(501)}, **{1000 + i: 1000 for i in range(50)}, 2000: 2000, 2001: 2000}
        assert components(df.limit(0), **options).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(12)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(420)]
    want = plain_components(range(900), lambda a, b, found={*links}: (a, b) in found or (b, a) in found)
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    for options in ({}, {"few": 0, "hot": 2}):
        got = {r.node: r.component for r in components(df, **options).collect()}
        assert {i: got.get(i, i) for i in range(900)} == want


def test_very_long_text(spark):
    texts = {1: "one two three four five " * 200_000, 2: "one two three four five " * 200_000 + "six", 3: "x" * 3_000_000}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_components(df).collect()}
    assert got == {1: (got[1][0], 1), 2: (got[2][0], 1), 3: (f"{plain_fingerprint(texts[3]):016x}", 3)}


def test_no_folder_of_one_machine_on_a_cluster(spark):
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            class _jsc:  # noqa: N801
                @staticmethod
                def sc():
                    class Context:
                        @staticmethod
                        def getCheckpointDir():
                            class Empty:
                                isDefined = staticmethod(lambda: False)

                            return Empty

                    return Context

    with pytest.raises(ValueError, match="checkpoint"):
        shared_base(Cluster)


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(3, None, "f"), (2, "", "g"), (None, " ", "h"), (5, "A b", "i"), (5, "a  B", "j"), (None, "zz", "k")], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash_components(df).collect()), key=str)
    assert got == sorted([(3, 2), (2, 2), (None, 2), (5, 5), (5, 5), (None, None)], key=str)
    assert simhash_components(df.limit(0)).count() == 0
    assert sorted((r.doc_id, r.kept) for r in simhash_components(df).collect() if r.doc_id) == [(2, True), (3, False), (5, True), (5, True)]
    assert all(r.kept for r in simhash_components(df).collect() if r.doc_id is None)
