"""PII: patterns for direct identifiers, and information-theoretic sanitisation of the terms that give them away.

Protected entities are identifiers and what they belong to: a domain, a network, an issuer, an area. What a term t tells of an entity e is the pointwise mutual information PMI(e; t) = log2(P(e | t) / P(e)) of their occurrences in documents; what there is to tell
is IC(e) = -log2 P(e). A term discloses an entity if PMI reaches a share of IC and if that can't be chance: were the term
spread over documents without regard to the entity, then so many different texts with both would be found for one of all the pairs compared with a
probability of `chance` at most (the Chernoff bound of the binomial tail, times the pairs). All is counted over whole documents and all documents; copies of a text
are one piece of evidence. A disclosing term is generalised wherever it stands in the documents that hold the entity.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, documents, map_batches, small_batches, texts

KINDS = ("email", "ip", "card", "phone", "term")
#: Fixed patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TERM = re.compile(r"[^\W\d_]{3,}")
#: Share of an entity's information that may not be told; the probability of a pair of all that is disclosing by chance.
SHARE, CHANCE = 0.9, 0.01
#: Terms that a task counts before it hands them on.
HELD = 400_000
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL; only the stretches around an @ are searched, which no match can leave."""
    at, n = text.find("@"), len(text)
    while at >= 0:
        low, high = at, at + 1
        while low and text[low - 1] in LOCAL:
            low -= 1
        while high < n and (text[high] in LOCAL or text[high] == "@"):
            high += 1
        for m in EMAIL.finditer(text, low, high):
            yield m.start(), m.end()
        at = text.find("@", high)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind as listed."""
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 10 else not p.strip("0") or (len(p.lstrip("0")) <= 3 and int(p.lstrip("0")) <= 255) for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return found


def told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for a, b, k in spans])


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 0) - (1 << 63)


def entity(kind: str, value: str) -> str:
    """One spelling of an identifier: letters small, digits alone."""
    return value.lower() if kind in ("email", "ip") else kind + "".join(c for c in value if c.isdigit())


def classes(kind: str, value: str) -> list[str]:
    """What an identifier belongs to, which others share: an address's domain, a network, an issuer of cards, an area of phone numbers."""
    if kind == "email":
        return ["@" + value.lower().partition("@")[2]]
    if kind == "ip":
        return [value.rpartition(".")[0] + "."]
    digits = "".join(c for c in value if c.isdigit())
    return [f"{kind}:{digits[:6]}"]


FOUND = "doc_id long, key long, tag long, n_email long, n_ip long, n_card long, n_phone long, base array<struct<start:int,end:int,kind:string>>, entities array<long>, text string"


def _find(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Base spans and entities of each document, and its text if it has any."""
    base, entities, counts, kept = [], [], [], []
    for text in texts(batch):
        spans = base_spans(text)
        n = Counter(k for _, _, k in spans)
        counts.append([n[k] for k in KINDS[:4]])
        base.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
        entities.append(sorted({_hash(x) for a, b, k in spans for x in (entity(k, text[a:b]), *classes(k, text[a:b]))}))
        kept.append(text if spans else None)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    return pa.record_batch([batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2), *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True)), pa.array(base, span), pa.array(entities, pa.list_(pa.int64())), pa.array(kept, pa.string())], [x.rsplit(" ", 1)[0] for x in FOUND.split(", ")])


def outside(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Begin, end and lower-case spelling of the terms that touch no span (spans by start)."""
    i, reach = 0, 0
    for m in TERM.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach = max(reach, spans[i][1])
            i += 1
        if reach <= m.start():
            yield m.start(), m.end(), m[0].lower()


def _pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(entity, term, text) for those entities of each document that other texts hold too, and its terms."""
    rows: list[tuple[int, int, int]] = []
    for text, spans, entities in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        told = {_hash(t) for _, _, t in outside(text, [(s["start"], s["end"]) for s in spans])}
        code = _hash(text)
        rows += [(e, t, code) for e in entities for t in told]
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3, ["entity", "term", "code"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, counted within a task as far as memory goes."""
    seen: Counter[str] = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        if seen:
            yield pa.record_batch([pa.array(map(_hash, seen), pa.int64()), pa.array(seen.values(), pa.int64())], ["term", "n"])
            seen.clear()

    for batch in batches:
        for text in texts(batch):
            seen.update(set(TERM.findall(text.lower())))
            if len(seen) > HELD:
                yield from out()
    yield from out()


def disclosed(found: DataFrame, terms: DataFrame, documents: int, *, share: float = SHARE, chance: float = CHANCE) -> DataFrame:
    """(entity, term) pairs above the threshold, with their pmi and ic in bits and the natural logarithm of the bound on chance.

    Entities that stand in one text only are left out: one text, however many copies it has, is no evidence.
    """
    held = found.select("key", "tag", F.xxhash64("text").alias("code"), F.explode("entities").alias("entity"))
    each = held.groupBy("entity").agg(F.count("*").alias("docs"), F.min("code").alias("a"), F.max("code").alias("b")).where("a < b").select("entity", "docs")
    each = cut(each)
    again = held.join(each.select("entity"), "entity", "left_semi").groupBy(F.col("key").alias("_key"), F.col("tag").alias("_tag")).agg(F.collect_set("entity").alias("again"))
    marked = found.where(F.size("entities") > 0).join(again, (F.col("key") == F.col("_key")) & (F.col("tag") == F.col("_tag"))).select("text", "base", "again")
    pairs = map_batches(marked, _pairs, "entity long, term long, code long")
    both = pairs.groupBy("entity", "term", "code").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.count("*").alias("texts"), F.sum("n").alias("both"))
    both = cut(both)
    tested = both.count()
    likely = both.where("texts > 1").join(each, "entity").join(terms, "term")
    total = F.lit(float(documents))
    p, q = F.col("both") / F.col("n"), F.col("docs") / total
    evidence = F.col("n") * F.col("texts") / F.col("both")
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - q))).otherwise(0.0)
    bound = F.log(F.lit(float(max(1, tested)))) - evidence * (p * F.log(p / q) + rest)
    told = likely.where(F.col("docs") < documents).select("entity", "term", F.log2(p / q).alias("pmi"), (-F.log2(q)).alias("ic"), bound.alias("bound"))
    return told.where(F.col("pmi") >= F.col("ic") * share).where(F.col("bound") <= math.log(chance))


def _marks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Spans of the disclosing terms of each document."""
    more = []
    for text, spans, wanted in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
        wanted = set(wanted)
        more.append([{"start": a, "end": b} for a, b, t in outside(text, [(s["start"], s["end"]) for s in spans]) if _hash(t) in wanted])
    return pa.record_batch([batch.column(0), batch.column(1), pa.array(more, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["_key", "_tag", "more"])


def sanitise(docs: DataFrame, *, share: float = SHARE, chance: float = CHANCE) -> DataFrame:
    """Per document doc_id, key, tag, the counts of base kinds, and arrays of spans: base, and terms that disclose an entity of the document.

    Null and empty text: none. Null doc_ids are kept; repeated rows are told apart from others by doc_id and text, count as documents of their own
    and get the same spans; copies of one text are one piece of evidence, so they alone prove nothing. No rows give no rows; only doc_id and text are read. A
    span of a term never touches a base span.
    """
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text", F.lit(1), "doc_id").alias("tag"), "text")
    small_batches(docs.sparkSession)
    found = cut(map_batches(keyed, _find, FOUND))
    terms = docs.select("text").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    pairs = disclosed(found, terms, found.count(), share=share, chance=chance)
    holders = found.where(F.size("entities") > 0).select("key", "tag", F.explode("entities").alias("entity")).distinct()
    wanted = holders.join(pairs.select("entity", "term"), "entity").groupBy(F.col("key").alias("_key"), F.col("tag").alias("_tag")).agg(F.collect_set("term").alias("wanted"))
    told = found.where(F.size("entities") > 0).dropDuplicates(["key", "tag"]).join(wanted, (F.col("key") == F.col("_key")) & (F.col("tag") == F.col("_tag"))).select("key", "tag", "text", "base", "wanted")
    more = map_batches(told, _marks, "_key long, _tag long, more array<struct<start:int,end:int>>")
    return found.drop("entities", "text").join(more, (F.col("key") == F.col("_key")) & (F.col("tag") == F.col("_tag")), "left").drop("_key", "_tag")


def pii(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts, base_sha256 and spans of sanitise(), and how many spans there are: of terms, and in all."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, spans, terms, n = [], [], [], []
        for b, m in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
            direct = [(s["start"], s["end"], s["kind"]) for s in b]
            every = sorted(direct + [(s["start"], s["end"], "term") for s in m or ()], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            base.append(hashlib.sha256(told(direct).encode()).hexdigest())
            spans.append(told(every))
            terms.append(len(m or ()))
            n.append(len(every))
        return pa.record_batch([*batch.columns[:5], pa.array(base), pa.array(spans), pa.array(terms, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term", "n_spans"])

    return map_batches(sanitise(docs, **options).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "more"), digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_term long, n_spans long")


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span generalised to its kind; of overlapping spans the first (and then the longest) names the stretch."""
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], MASKS[kind]]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all columns, with personal data generalised; n_chars, if there is one, counts what there is then.

    Null text stays null. Null doc_ids are kept; repeated rows get the same masks; no rows give no rows; columns may have any names.
    """
    names, schema = docs.columns, docs.schema
    spans = sanitise(docs.select("doc_id", "text"), **options).groupBy("key", "tag").agg(F.first("base").alias("_base"), F.first("more").alias("_more"))
    spans = spans.where((F.size("_base") > 0) | (F.size("_more") > 0)).select(F.col("key").alias("_k"), F.col("tag").alias("_t"), "_base", "_more")
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("_row"), F.xxhash64("doc_id", "text").alias("_key"), F.xxhash64("text", F.lit(1), "doc_id").alias("_tag"))
    joined = rows.join(spans, (F.col("_key") == F.col("_k")) & (F.col("_tag") == F.col("_t")), "left").select("_row.*", "_base", "_more")
    joined = joined.toDF(*(f"c{i}" for i in range(len(names))), "_base", "_more")
    at = names.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns[: len(names)])
        out = []
        for text, base, more in zip(columns[at].to_pylist(), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True):
            spans = [(s["start"], s["end"], s["kind"]) for s in base or ()] + [(s["start"], s["end"], "term") for s in more or ()]
            out.append(masked(text, spans) if spans else text)
        columns[at] = pa.array(out, pa.string())
        if "n_chars" in names:
            k = names.index("n_chars")
            columns[k] = pa.array([n if t == old else len(t) for t, old, n in zip(out, batch.column(at).to_pylist(), columns[k].to_pylist(), strict=True)], columns[k].type)
        return pa.record_batch(columns, names)

    return map_batches(joined, run, StructType(schema.fields))


def op8_pii_infotheoretic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(documents(spark, sf_dir))
