"""Documents seen as papers: the staging view that most queries read, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging records: the digest of a text identifies it, the first line is the title, the rest the abstract."""
    docs = read(spark, sf_dir, "documents")
    digest = F.md5(F.lower(F.trim("text")))
    kind = F.when(F.substring(digest, 1, 1) < "3", "arxiv_id").otherwise("doi")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.select(
        F.col("doc_id").alias("staging_id"), "source", (F.substring("source", 4, 9).cast("int") + 1).alias("source_priority"), F.when(kind == "doi", digest).alias("doi"), F.when(kind == "arxiv_id", digest).alias("arxiv_id"),
        kind.alias("identifier_type"), digest.alias("identifier_value"), F.concat(kind, F.lit(":"), digest).alias("identifier_key"), title.alias("title"), F.expr("substr(text, length(split_part(text, '\n', 1)) + 2)").alias("abstract"), "lang",
    )


SQL = """
p0 AS (SELECT doc_id AS staging_id, source, CAST(substr(source, 4) AS INTEGER) + 1 AS source_priority, md5(lower(trim(text))) AS identifier_value,
  split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS abstract, lang FROM documents),
papers AS (SELECT *, CASE WHEN substr(identifier_value, 1, 1) < '3' THEN 'arxiv_id' ELSE 'doi' END AS identifier_type,
  CASE WHEN substr(identifier_value, 1, 1) < '3' THEN NULL ELSE identifier_value END AS doi, CASE WHEN substr(identifier_value, 1, 1) < '3' THEN identifier_value END AS arxiv_id,
  CASE WHEN substr(identifier_value, 1, 1) < '3' THEN 'arxiv_id' ELSE 'doi' END || ':' || identifier_value AS identifier_key FROM p0)
"""


def sql(body: str) -> str:
    return f"WITH {SQL} {body}"
