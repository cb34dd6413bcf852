import base64
import random
import re
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusloom.llm.compression_bands import BANDS, CHUNK_BAND, bands_of, compression_bands, documents, fit_bands, keep_good, limit, op1_compression_bands, repeat_words

from .conftest import DATA


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def plain_verdict(text, bands=BANDS, chunk_band=CHUNK_BAND):
    """Whether the method keeps a text, told from its definition."""
    z = zstandard.ZstdCompressor(level=3, write_content_size=False)
    raw = text.encode()
    ratio = lambda x: len(z.compress(x)) / len(x) if x else 1.0
    low, high = [b[1:] for b in bands if len(raw) >= b[0]][-1]
    parts = [raw[i : i + 2048] for i in range(0, len(raw), 2048)]
    if len(parts) > 1 and len(parts[-1]) < 1024:
        parts[-2:] = [parts[-2] + parts[-1]]
    bad = sum(not chunk_band[0] <= ratio(x) <= chunk_band[1] for x in parts) if len(parts) > 1 else 0
    return low <= ratio(raw) <= high and 4 * bad <= len(parts)


def test_query_equals_brute_force(spark):
    for sf in ("0.001", "0.01"):
        at = f"/root/testdata/sf{sf}"
        docs = documents(spark, at)
        bands, chunk_band = fit_bands(docs, spark.read.parquet(f"{at}/labels.parquet"))
        rows = {r.doc_id: r.text or "" for r in docs.collect()}
        long = 0
        for r in op1_compression_bands(spark, at).collect():
            text = rows.pop(r.doc_id)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text)
            assert r.kept == (not r.base_failed and plain_verdict(text, bands, chunk_band))
            long += r.n_chunks > 1
        assert not rows and long > 10


def test_bands_part_held_out_labels(spark):
    at = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    some = documents(spark, at).join(labels.select("doc_id"), "doc_id", "left_semi")
    bands, chunk_band = fit_bands(some, labels)
    held = some.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    got = compression_bands(held, bands=bands, chunk_band=chunk_band).where("not base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    bad = [r.kept for r in got if r.quality == 0]
    good = [r.kept for r in got if r.quality == 1]
    assert len(bad) > 30 and sum(not k for k in bad) > 0.5 * len(bad)
    assert sum(good) > 0.99 * len(good)
    # learned from the others alone
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_bands(some, turned) == (bands, chunk_band)


def test_noise_is_outside_the_bands(spark):
    rng = random.Random(11)
    at = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    bands, chunk_band = fit_bands(documents(spark, at).join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    for n in (2000, 8000, 80_000):
        raw = rng.randbytes(n)
        kinds = (base64.b64encode(raw).decode(), raw.hex(), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)))
        for text in kinds:
            assert not plain_verdict(" ".join(text[i : i + 8] for i in range(0, len(text), 8)), bands, chunk_band)


def test_limits():
    import numpy as np

    assert limit(np.array([5.0, 6.0]), np.array([1.0, 2.0])) == pytest.approx(3.5)
    assert limit(np.array([1.0, 6.0]), np.array([2.0, 3.0])) is None
    assert limit(np.array([5.0]), np.array([])) is None
    assert bands_of([]) == (BANDS, CHUNK_BAND)
    same = bands_of([(True, 1000, 0.5, [])] * 200)  # ties: no spread
    assert next(b for b in reversed(same[0]) if b[0] <= 1000)[1] < 0.5 < next(b for b in reversed(same[0]) if b[0] <= 1000)[2]


def test_labels_that_are_odd(spark):
    docs = spark.createDataFrame([(1, "a b", 0), (None, "c", 1), (2, None, 2)], "doc_id long, text string, _good int")
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "y"), (None, 1, "z"), (2, None, "w"), (2, 1, "v")], "doc_id long, quality int, _id string")
    assert fit_bands(docs, labels) == fit_bands(docs.limit(0), labels) == fit_bands(docs, labels.limit(0)) == (BANDS, CHUNK_BAND)


def test_repeat_words_on_small_alphabets():
    rng = random.Random(9)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 12))]
        assert repeat_words(words) == brute(b" ".join(words).decode())[4]


def test_bands_nulls_repeats_and_nothing(spark):
    rng = random.Random(10)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(400))
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(9)) for _ in range(400))
    dull = "".join(f"row {i} of the very same long and boring table, nothing else to see here\n" for i in range(60))
    df = spark.createDataFrame([(1, prose, "a"), (2, noise, "b"), (3, dull, "c"), (4, None, "d"), (5, "", "e"), (None, prose, "f"), (1, prose, "a")], "doc_id long, text string, kept string")
    got = {r.doc_id: (r.kept, r.base_failed) for r in compression_bands(df).collect()}
    assert got[1] == (True, False) and got[None] == (True, False) and got[4] == got[5] == (False, True) and not got[3][0]
    assert compression_bands(df).count() == 7 and compression_bands(df.limit(0)).count() == 0
    assert sorted(r.kept for r in keep_good(df).collect() if r.doc_id != 2) == ["a", "a", "f"]
