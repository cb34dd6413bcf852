import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from .conftest import DATA
from .test_compression_bands import brute, plain_verdict
from .test_near_texts import components_of
from .test_pii_infotheoretic import plain, plain_terms
from .test_suffix_radix import without_later

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def good(text):
    return not brute(text)[5] and plain_verdict(text)


def masked(texts):
    out = []
    for text, terms in zip(texts, plain_terms(texts), strict=True):
        said, at = [], 0
        for a, b, kind in sorted(plain(text) + [(a, b, "term") for a, b in terms], key=lambda s: (s[0], -s[1])):
            if a >= at:
                said += [text[at:a], f"<{kind.upper()}>"]
            at = max(at, b)
        out.append("".join([*said, text[at:]]))
    return out


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    texts = {d: t for d, t in docs.items() if good(t)}
    component = components_of(texts)
    texts = {d: t for d, t in texts.items() if component[d] == d}
    assert 0 < len(texts) < len(docs)
    short = without_later([*texts.items()], 50)
    assert short != texts
    texts = dict(zip(short, masked([*short.values()]), strict=True))
    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    ids = {d: [*tok.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}
    found = defaultdict(int)
    for r in corpus_pipeline.run(spark, DATA).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        found[r.doc_id] += r.length
    assert found == {d: len(x) for d, x in ids.items()}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    clash = docs.selectExpr("*", "doc_id as _gone", "text as _key", "1 as `a.b`", "2 as key", "lang as _id", "3 as fp", "4 as _spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).schema.names == docs.columns, name
        assert stage(spark, docs.limit(0), DATA).count() == 0
        rows = {r.doc_id: r for r in clash.collect()}
        got = stage(spark, clash, DATA).collect()
        assert got and all(r._gone == r.doc_id and r._key == rows[r.doc_id].text and r["a.b"] == 1 and r._spans == 4 for r in got), name


def test_odd_rows_through_every_stage(spark):
    long = " ".join(f"w{i}" for i in range(90_000))
    rows = [(None, None, None), (None, "", "x"), (1, None, None), (1, long, None), (1, long, None), (2, "a " * 30_000, "x"), (3, "\n\t ", "y"), (4, "x" * 2_000_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, DATA).collect()
        if name == "quality rules":
            assert [(r.doc_id, r.text) for r in got] == [(1, long)] * 2 or not got
        elif name.endswith("near-dedup"):
            assert len(got) == 4
        elif name != "packing":
            assert len(got) == len(rows)


def test_intermediate_tables_go(spark, tmp_path):
    from pathlib import Path

    at = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {x.name for x in at.glob("pipeline-*")}
    corpus_pipeline.run(spark, DATA).count()
    assert len({x.name for x in at.glob("pipeline-*")} - before) <= 1
