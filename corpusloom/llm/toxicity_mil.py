"""Toxicity by multiple-instance learning: sentences combined by noisy-or, trained from document labels alone.

A sentence has probability s(z) with z a sum of weights of its words and of their first letters; a document is toxic if any of its sentences is:
P = 1 - prod(1 - s(z)). Only P is compared with the label, and the weights that this leaves locate the offending sentences.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_batches, texts

#: A word, or the end of a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
STOPS = frozenset(".!?\n")
SLOTS, STEMS = 1 << 18, (4, 5, 6)
#: Labelled documents of each class that the model is fitted on, at most: those with the least hashes of their ids; bytes of their texts, up to one text more.
SAMPLE, SAMPLE_BYTES = 3000, 16 << 20
EPOCHS, RATE, SHRINK, START = 160, 0.3, 2e-4, -10.0
CACHE = 500_000


def slots(word: str) -> list[int]:
    """Places of a lower-case word's features: the word and, if it is longer, its first letters."""
    found = [zlib.crc32(b"w" + word.encode("utf-8", "surrogatepass")) % SLOTS]
    for n in STEMS:
        if len(word) > n:
            found.append(zlib.crc32(b"s" + word[:n].encode("utf-8", "surrogatepass")) % SLOTS)
    return found


def sentences(text: str) -> list[list[str]]:
    """Lower-case words of each sentence that has any."""
    out: list[list[str]] = [[]]
    for token in TOKEN.findall(text.lower()):
        if token[0] in STOPS:
            if out[-1]:
                out.append([])
        else:
            out[-1].append(token)
    return out if out[-1] else out[:-1]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def word(self, word: str) -> float:
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            value = self.cache[word] = float(sum(self.weights[i] for i in slots(word)))
        return value

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the document, and begin, end and probability of each sentence that is likelier than not."""
        left, worst, z, begin, some = 0.0, [], self.bias, None, False
        base = softplus(z) if z < 0 else 0.0  # what a sentence without a telling word has, so that any number of them stays harmless
        word = self.word
        lower = text.lower()
        offsets_hold = len(lower) == len(text)
        end = 0
        for m in TOKEN.finditer(lower):
            token = m[0]
            if token[0] in STOPS:
                if some:
                    left += softplus(z) - base
                    if z >= 0:
                        worst.append((begin, m.end(), 1 / (1 + math.exp(-z))))
                    z, some = self.bias, False
                continue
            if not some:
                begin, some = m.start(), True
            z += word(token)
            end = m.end()
        if some:
            left += softplus(z) - base
            if z >= 0:
                worst.append((begin, end, 1 / (1 + math.exp(-z))))
        if not offsets_hold:
            worst = [(min(a, len(text)), min(b, len(text)), p) for a, b, p in worst]
        return -math.expm1(-left), worst


def softplus(z: float) -> float:
    return math.log1p(math.exp(-abs(z))) + max(z, 0.0)


def fit(bags: list[list[np.ndarray]], labels: np.ndarray, weights: np.ndarray, *, epochs: int = EPOCHS, rate: float = RATE, shrink: float = SHRINK, start: float = START) -> Model:
    """Adam on the weighted log loss of the noisy-or over bags of sentences, each an array of feature places.

    Weights are never negative: a sentence is as toxic as its worst words, however long it is and whatever else it says. `shrink` is the
    price of a unit of weight, which keeps features of single documents at zero.
    """
    w = np.zeros(SLOTS)
    bias = np.array(start)
    flat = [s for bag in bags for s in bag]
    if not flat or len(set(labels.tolist())) < 2:
        share = float(np.average(labels, weights=weights)) if len(labels) else 0.0
        return Model(w, start if share < 0.5 else 0.0)
    feature = np.concatenate(flat)
    sentence = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    used, feature = np.unique(feature, return_inverse=True)
    theta = np.zeros(len(used))
    weights = weights / weights.sum()
    m, v, mb, vb = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    for t in range(1, epochs + 1):
        z = bias + np.bincount(sentence, theta[feature], len(flat))
        soft = np.logaddexp(0, z)
        total = np.bincount(doc, soft, len(bags))
        slope = weights * np.where(labels == 1, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        dz = slope[doc] * np.exp(z - soft)
        grad = np.bincount(feature, dz[sentence], len(used)) + shrink
        db = dz.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * db, 0.99 * vb + 0.01 * db * db
        step = rate * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        theta = np.maximum(theta - step * m / (np.sqrt(v) + 1e-8), 0)
        bias = np.minimum(bias - step * mb / (math.sqrt(vb) + 1e-7), START)  # so that thousands of harmless sentences stay harmless
    w[used] = theta
    return Model(w, float(bias))


def held_out(doc_id: Column) -> Column:
    """Whether labels of a row are kept from training; a null id is never held out (and never labelled)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most `sample` labelled documents of each class that are not held out, and `sample_bytes` of their texts; classes weigh as they occur.

    Of several labels of one document the highest counts; null labels and ids are left out. With no labels of one class, nothing is toxic
    (or, if all are, what has a sentence is).
    """
    marked = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("_toxic"))
    counts = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    picked = [marked.where(F.col("_toxic") == c).withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(sample).select("_id", "_toxic", "_h") for c in (0, 1)]
    few = F.broadcast(picked[0].union(picked[1]))  # at most 2 * sample rows

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[[i for w in s for i in slots(w)] for s in sentences(t)] for t in texts(batch)]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.list_(pa.int32())))], ["doc_id", "toxic", "bags"])

    joined = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("_id")).withColumn("_n", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    before = F.sum("_n").over(Window.partitionBy("_toxic").orderBy("_h", "_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1))
    joined = joined.where(F.col("_n") < sample_bytes).withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < sample_bytes).select("doc_id", F.col("_toxic").alias("toxic"), "text")
    rows = map_batches(joined, features, "doc_id long, toxic int, bags array<array<int>>").toArrow().sort_by("doc_id")
    y = rows.column("toxic").to_numpy().astype(np.int64)
    bags = []
    for chunk in rows.column("bags").chunks:
        inner = chunk.values
        places, cuts = inner.values.to_numpy(), inner.offsets.to_numpy()
        for a, b in zip(chunk.offsets.to_pylist(), chunk.offsets.to_pylist()[1:], strict=False):
            bags.append([places[cuts[i] : cuts[i + 1]] for i in range(a, b)])
    seen = np.bincount(y, minlength=2)
    weights = np.array([counts.get(c, 0) / max(1, seen[c]) for c in (0, 1)])[y] if len(y) else np.zeros(0)
    return fit(bags, y, weights)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_offending int, offending array<struct<begin:int,end:int,score:double>>"


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Score every whole text: the columns of SCHEMA; `offending` are sentences likelier toxic than not, as code points.

    Null and empty texts, and texts without words, have no sentence and score 0. Null doc_ids and repeated rows are scored like others; no
    rows give no rows; only doc_id and text are read, and only the text counts for the score.
    """
    weights, bias = model.weights.astype(np.float32), model.bias
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))  # SLOTS floats
    held: dict[int, Model] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if 0 not in held:
            held[0] = Model(*shared.value)
        got = [held[0].score(t) for t in texts(batch)]
        p = [x[0] for x in got]
        spans = [[{"begin": a, "end": b, "score": s} for a, b, s in x[1]] for x in got]
        return pa.record_batch(
            [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32()), pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))],
            ["doc_id", "held_out", "score", "predicted", "n_offending", "offending"],
        )

    return map_batches(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), run, SCHEMA)


def op2_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
