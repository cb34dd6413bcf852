"""Corpus pipeline: quality rules, near and substring deduplication, PII and packing, each over what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import documents, remove_dir, shared_dir
from corpusloom.llm.compression_bands import fit_bands, keep_good
from corpusloom.llm.near_texts import drop_near_texts
from corpusloom.llm.packing_dp import pack
from corpusloom.llm.pii_infotheoretic import redact
from corpusloom.llm.suffix_radix import remove_repeats
from public_tokenizers import path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the compression bands that pass the base rules.

    Null and empty texts go. Repeated rows are judged alike, and all stay or go. No rows give no rows, and with few labels fixed bands hold.
    """
    bands, chunk_band = fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, bands=bands, chunk_band=chunk_band)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, with the smallest doc_id, of each component of five-word Jaccard similarity 0.8 or more: SimHash's pairs and those beyond its radius.

    Null and empty texts are copies of each other, so one such row stays. Of repeated rows one stays; a null doc_id comes last. No rows give no rows.
    """
    return drop_near_texts(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 50 words that begin earlier in the corpus too; the first place keeps them.

    Every row stays, also one whose text is empty then. Null texts stay null. A null doc_id comes after all others. No rows give no rows.
    """
    return remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with identifiers, and terms that disclose them, generalised.

    Every row stays. Null texts stay null; repeated rows get the same masks; no rows give no rows.
    """
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences of at most 1024 tokens.

    Null and empty texts are one closing token. Repeated rows are packed each. No rows give no pieces.
    """
    return pack(docs, path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_dedup), ("suffix-array dedup", substring_dedup), ("PII", personal_data), ("packing", packing)]
#: No stage after the first can be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written and read again as the next one's input, and removed when that one is written.

    The last of these tables stays in the shared folder, since the result reads it.
    """
    docs, before = documents(spark, sf_dir), None
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return made
        at = shared_dir(spark, f"pipeline-{i}")
        made.write.parquet(at)
        docs = spark.read.parquet(at)
        if before:
            remove_dir(spark, before)
        before = at
    return docs
