"""Quality rules: bands of zstandard ratios over whole documents and fixed chunks.

Repetitive text and tables compress far better than prose of its length, noise far worse; short texts compress less, so the
accepted band depends on the length. `fit_bands` finds it on labelled documents: the ratios of good ones are a curve over the logarithm of the
length with a spread, and the limits are so many spreads from it as part the labels best.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import documents, map_batches

#: From so many bytes on: least and greatest accepted ratio of compressed to plain bytes, where no labels say otherwise.
BANDS = ((0, 0.0, 9.0), (128, 0.42, 1.15), (256, 0.42, 0.95), (512, 0.41, 0.75), (1024, 0.39, 0.7), (2048, 0.37, 0.66), (4096, 0.36, 0.62), (16384, 0.33, 0.58), (65536, 0.3, 0.56))
CHUNK, CHUNK_BAND, BAD_CHUNKS = 2048, (0.25, 0.66), 0.25
#: Labelled documents of each class that the bands are fitted on, at most: those with the least hashes of their ids; fewer good ones than LEAST leave BANDS.
SAMPLE, LEAST, GROUPS = 3000, 100, 24
#: Bad documents that one good one is worth; spreads between the farthest good document and a limit that no bad one sets.
WORTH, MARGIN = 10, 1.0
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "ratio double, n_chunks long, n_bad_chunks long, reject_reason string"
)


def repeat_words(words: Sequence[bytes], width: int = 3) -> int:
    """How many words lie in a window of `width` words that is found twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    keys = codes[: n - width + 1].copy()
    size = len(ids)
    for i in range(1, width):
        keys = keys * size + codes[i : n - width + 1 + i]
        if i < width - 1 and size**3 >= 1 << 62:
            keys, size = np.unique(keys, return_inverse=True)[1].astype(np.int64), size
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    many = np.zeros(len(keys), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for i in range(width):
        hit[i : n - width + 1 + i] |= many
    return int(hit.sum())


def base_counts(text: str, raw: bytes) -> tuple[int, int, int, int, int]:
    words = raw.split()
    lines: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in lines:
                dup += 1
            else:
                lines.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeat_words(words)


class Bands:
    """Ratios of one text against the bands; one compressor serves all texts of a task."""

    def __init__(self, bands=BANDS, chunk=CHUNK, chunk_band=CHUNK_BAND, bad_chunks=BAD_CHUNKS, level=3):
        self.bands, self.chunk, self.chunk_band, self.bad_chunks = bands, chunk, chunk_band, bad_chunks
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)

    def ratio(self, raw: bytes) -> float:
        return len(self.compressor.compress(raw)) / len(raw) if raw else 1.0

    def chunks(self, raw: bytes) -> list[float]:
        """Ratios of the chunks; none for a text of one. A last chunk of under half the size counts with its predecessor."""
        n = max(1, (len(raw) + self.chunk // 2) // self.chunk)
        return [self.ratio(raw[i * self.chunk : (i + 1) * self.chunk if i < n - 1 else len(raw)]) for i in range(n)] if n > 1 else []

    def verdict(self, raw: bytes) -> tuple[float, int, int, str | None]:
        """ratio, chunks, chunks outside their band, why it is rejected."""
        whole = self.ratio(raw)
        _, low, high = next(b for b in reversed(self.bands) if len(raw) >= b[0])
        parts = self.chunks(raw)
        bad = sum(not self.chunk_band[0] <= got <= self.chunk_band[1] for got in parts)
        why = "repetitive" if whole < low else "incompressible" if whole > high else "bad chunks" if bad > self.bad_chunks * len(parts) else None
        return whole, max(1, len(parts)), bad, why


def limit(good: np.ndarray, bad: np.ndarray, worth: float = WORTH) -> float | None:
    """The limit under which `worth` times the good values weigh least against the bad ones; the lowest such, none if no bad value is worth it."""
    cuts = np.unique(bad)
    if not len(cuts):
        return None
    after = np.nextafter(cuts, np.inf)
    gain = np.searchsorted(np.sort(bad), after) - worth * np.searchsorted(np.sort(good), after)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return None
    above = np.concatenate([good, bad])
    above = above[above >= after[best]]
    return float((cuts[best] + above.min()) / 2) if len(above) else float(after[best])


def bands_of(rows: list[tuple[bool, int, float, list[float]]], *, worth: float = WORTH, margin: float = MARGIN, least: int = LEAST) -> tuple[tuple, tuple]:
    """Bands and chunk band from (good, bytes, ratio, deciding) of labelled documents.

    A document is rejected if over BAD_CHUNKS of its chunks lie outside their band: that is if its deciding chunks do, those at that share of
    their order from below and from above (none for a text of one chunk).
    Limits reach from the shortest good document to the longest; beside that BANDS hold.
    """
    good = np.array([r[0] for r in rows], bool)
    if good.sum() < least:
        return BANDS, CHUNK_BAND
    size = np.log2([max(1, r[1]) for r in rows])
    ratio = np.array([r[2] for r in rows])
    # the curve: centres of groups of good documents of like length, and how far these lie from it
    groups = np.array_split(np.argsort(size[good], kind="stable"), max(1, min(GROUPS, int(good.sum()) // (least // 2))))
    mids, centres = (np.array([np.median(x[good][g]) for g in groups]) for x in (size, ratio))
    curve = lambda x: np.interp(x, mids, centres)
    off = ratio - curve(size)
    spreads = np.array([max(1e-3, off[good][g].std()) for g in groups])
    wide = lambda x: np.interp(x, mids, spreads)
    z = off / wide(size)
    low = limit(z[good], z[~good], worth)
    low = z[good].min() - margin if low is None else low
    high = -limit(-z[good], -z[~good], worth) if limit(-z[good], -z[~good], worth) is not None else z[good].max() + margin
    steps = np.arange(math.floor(4 * size[good].min()), math.ceil(4 * size[good].max()))
    inner = [(math.ceil(2 ** (k / 4)), float(curve(x) + low * wide(x)), float(curve(x) + high * wide(x))) for k in steps.tolist() for x in [(k + 0.5) / 4]]
    top = math.ceil(2 ** ((steps[-1] + 1) / 4))
    default = lambda n: next(b[1:] for b in reversed(BANDS) if n >= b[0])
    bands = [b for b in BANDS if b[0] < inner[0][0]] + inner + [(top, min(default(top)[0], inner[-1][1]), max(default(top)[1], inner[-1][2]))] + [b for b in BANDS if b[0] > top]
    some, rest = (np.array([c for g, _, _, c in rows if c and g is want]).reshape(-1, 2) for want in (True, False))
    if len(some) < least:
        return tuple(bands), CHUNK_BAND
    chunk_low = limit(some[:, 0], rest[:, 0], worth)
    return tuple(bands), (CHUNK_BAND[0] if chunk_low is None else chunk_low, float(some[:, 1].max() + margin * some.std()))


def fit_bands(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, min_words: int = 50, chunk: int = CHUNK, level: int = 3) -> tuple[tuple, tuple]:
    """Bands and chunk band, fitted on at most `sample` labelled documents of each class (labels.quality 1 or 0) that pass the base.

    Documents whose crc32(doc_id) is divisible by 5 are left out, so that precision and recall can be measured on them. Of several labels of one
    document the lowest counts, of rows that share a doc_id each one; null labels and ids are left out. With few or no labels BANDS hold. One row of
    numbers for each labelled document goes to the driver.
    """
    marked = labels.where("doc_id is not null and quality is not null").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.min((F.col("quality") > 0).cast("int")).alias("_good"))
    picked = [marked.where(F.col("_good") == c).withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(sample).select("_id", "_good") for c in (0, 1)]
    few = F.broadcast(picked[0].union(picked[1]))  # at most 2 * sample rows
    rows = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("_id")).select("_good", "doc_id", "text")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        band = Bands(chunk=chunk, level=level)
        out = []
        for good, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            words = raw.split()
            if len(words) >= min_words and 100 * repeat_words(words) <= 50 * len(words):
                parts = band.chunks(raw)
                if parts:  # what the limits of chunks depend on, whatever the length: the two chunks that decide
                    k = int(BAD_CHUNKS * len(parts))
                    parts = [sorted(parts)[k], sorted(parts)[-1 - k]]
                out.append((good, doc, len(raw), band.ratio(raw), parts))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64())), strict=True)], ["good", "doc_id", "n", "ratio", "deciding"]) if out else None

    found = map_batches(rows, measure, "good int, doc_id long, n long, ratio double, deciding array<double>").toArrow().sort_by([("doc_id", "ascending"), ("n", "ascending"), ("ratio", "ascending")])
    return bands_of([(g == 1, n, r, p) for g, _, n, r, p in zip(*(c.to_pylist() for c in found.columns), strict=True)])


def compression_bands(docs: DataFrame, *, min_words: int = 50, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND, bad_chunks: float = BAD_CHUNKS, level: int = 3) -> DataFrame:
    """Per document the base counts, the ratios and the verdict.

    Null or empty text: zero words, ratio 1, base_failed. Null doc_id is kept as null; repeated rows are judged
    alike and all returned; no rows give no rows; only doc_id and text are read, so other columns may have any name.
    Texts are judged whole however long they are; a task holds one batch of them.
    """

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        band = Bands(bands, chunk, chunk_band, bad_chunks, level)
        rows = []
        for text in (x or "" for x in batch.column(1).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            n, chars, symbols, dup, repeated = base_counts(text, raw)
            failed = n < min_words or 100 * repeated > 50 * n
            ratio, chunks, bad, why = band.verdict(raw)
            rows.append((n, chars, symbols, dup, repeated, failed, not failed and why is None, ratio, chunks, bad, "base" if failed else why))
        return pa.record_batch([batch.column(0).cast(pa.int64()), *map(pa.array, zip(*rows, strict=True))], [x.split()[0] for x in SCHEMA.split(", ")]).cast(ARROW)

    return map_batches(docs.select("doc_id", "text"), judge, SCHEMA)


ARROW = pa.schema([(name, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[kind]) for name, kind in map(str.split, SCHEMA.split(", "))])


def keep_good(docs: DataFrame, *, bands=BANDS, chunk_band=CHUNK_BAND) -> DataFrame:
    """The documents whose verdict is good, with all their columns.

    Null and empty texts fail the base and go; repeated rows are judged alike and all stay or go; a null doc_id changes nothing; no rows give no rows.
    Columns may have any names, as rows pass through as they are.
    """

    names = docs.columns
    at = names.index("text")

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        band = Bands(bands, chunk_band=chunk_band)
        good = []
        for text in (x or "" for x in batch.column(at).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            words = raw.split()
            good.append(len(words) >= 50 and 100 * repeat_words(words) <= 50 * len(words) and band.verdict(raw)[3] is None)
        return pa.record_batch(batch.filter(pa.array(good, pa.bool_())).columns, names)

    return map_batches(docs.toDF(*(f"c{i}" for i in range(len(names)))), judge, StructType(docs.schema.fields))


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    bands, chunk_band = fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression_bands(docs, bands=bands, chunk_band=chunk_band)
