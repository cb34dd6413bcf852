"""Abstract enrichment and harvest planning."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.unicode import clean_abstract
from ..operators.joins import absent, fallback


def new_papers(source: DataFrame, enriched: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that the enriched table lacks, with its columns."""
    rows = absent(source, enriched, keys)
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in enriched.schema if f.name not in source.columns}).select(*enriched.columns)


def crossref_fields(works: DataFrame) -> DataFrame:
    """doi, abstract, authors, affiliations of Crossref works(doi, message)."""
    m = F.col("message")
    return works.select(T.doi_strict(F.col("doi")).alias("doi"), clean_abstract(m["abstract"]).alias("abstract"), T.crossref_authors(m["author"]).alias("authors"), T.crossref_affiliations(m["author"]).alias("affiliations"))


def openalex_fields(works: DataFrame) -> DataFrame:
    """The same of OpenAlex works(doi, abstract_inverted_index, authorships)."""
    return works.select(T.doi_strict(F.col("doi")).alias("doi"), T.inverted_text(F.col("abstract_inverted_index")).alias("abstract"), T.openalex_authors(F.col("authorships")).alias("authors"), T.openalex_affiliations(F.col("authorships")).alias("affiliations"))


def enriched(papers: DataFrame, crossref: DataFrame, openalex: DataFrame) -> DataFrame:
    """Untested papers with what is missing filled: what is there first, then Crossref, then OpenAlex, with the name of the source; all are marked as
    tested, also those that neither knows."""
    base = papers.withColumn("_doi", T.doi_strict(F.col("doi")))
    for label, works in (("c", crossref), ("o", openalex)):
        one = works.where("doi <> ''").groupBy("doi").agg(*(F.min(c).alias(f"_{label}_{c}") for c in ("abstract", "authors", "affiliations")))
        base = base.join(one.withColumnRenamed("doi", f"_{label}"), F.col("_doi") == F.col(f"_{label}"), "left")
    out, open_ = {}, F.coalesce(F.col("doi_tested"), F.lit(0)) == 0
    for have, source, field in (("abstract", "abstract_source", "abstract"), ("authors_enriched", "authors_source", "authors"), ("affiliations_enriched", "affiliations_source", "affiliations")):
        value, name = fallback(F.col(have), ("crossref", F.col(f"_c_{field}")), ("openalex", F.col(f"_o_{field}")))
        out[have] = F.when(open_, F.coalesce(value, F.col(have))).otherwise(F.col(have))
        out[source] = F.when(open_ & name.isNotNull(), name).otherwise(F.col(source))
    return base.withColumns(out).withColumn("doi_tested", F.lit(1)).drop("_doi", "_c", "_o", *(f"_{s}_{f}" for s in "co" for f in ("abstract", "authors", "affiliations")))


def halved(span: tuple[int, int], least: int, minute: Column) -> Column:
    """The windows [a, z) that hold a minute when a span is halved down to `least` minutes, the span itself first."""
    depth = max(1, math.ceil(math.log2(max(2, span[1] - span[0]))) + 1)
    window = lambda a, z: F.struct(a.cast("long").alias("a"), z.cast("long").alias("z"))

    def halve(path: Column, _: Column) -> Column:
        last = F.element_at(path, -1)
        middle = F.floor((last["a"] + last["z"]) / 2)
        half = F.when(minute < middle, window(last["a"], middle)).otherwise(window(middle, last["z"]))
        return F.when(last["z"] - last["a"] <= least, path).otherwise(F.array_append(path, half))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(window(F.lit(span[0]), F.lit(span[1]))), halve)


def bucket_windows(stamps: DataFrame, column: str, most: int, start: datetime, end: datetime, least_minutes: int = 1) -> DataFrame:
    """low, high, n: windows [low, high) with at most `most` rows each, halved again and again where there are more; empty ones are left out.

    A roll-up tree: minutes are counted, every count is added to all windows of its path, and a window is cut where its own count fits but that of the window above doesn't.
    Rows are read once and meet as minutes, and nothing is decided on the driver. Rows outside of [start, end) and without a time don't count.
    """
    span = int(start.timestamp() // 60), int(-(-end.timestamp() // 60))
    minutes = stamps.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end))).groupBy(F.floor(F.unix_timestamp(column) / 60).alias("m")).agg(F.count("*").alias("n"))
    paths = minutes.select("n", halved(span, least_minutes, F.col("m")).alias("path")).select("n", "path", F.posexplode("path").alias("level", "w"))
    above = F.when(F.col("level") > 0, F.element_at("path", F.col("level")))
    tree = paths.select("n", "w.a", "w.z", above["a"].alias("up_a"), above["z"].alias("up_z")).groupBy("a", "z", "up_a", "up_z").agg(F.sum("n").alias("n"))
    parents = tree.select(F.col("a").alias("up_a"), F.col("z").alias("up_z"), F.col("n").alias("up_n")).where(F.col("up_n") > most)
    fits = (F.col("n") <= most) | (F.col("z") - F.col("a") <= least_minutes)
    cuts = tree.where(fits & F.col("up_a").isNull()).select("a", "z", "n").union(tree.where(fits).join(parents, ["up_a", "up_z"]).select("a", "z", "n"))
    return cuts.select(F.timestamp_seconds(F.col("a") * 60).alias("low"), F.timestamp_seconds(F.col("z") * 60).alias("high"), "n")


def date_buckets(stamps: DataFrame, column: str, most: int, start: datetime, end: datetime, least_minutes: int = 1) -> list[tuple[datetime, datetime, int]]:
    """bucket_windows() as a list in order of time, to plan a harvest with: the driver gets the windows and nothing else."""
    found = bucket_windows(stamps, column, most, start, end, least_minutes)
    rows = found.select(F.unix_timestamp("low").alias("a"), F.unix_timestamp("high").alias("z"), "n").orderBy("a").collect()
    return [(datetime.fromtimestamp(r["a"], start.tzinfo), datetime.fromtimestamp(r["z"], start.tzinfo), r["n"]) for r in rows]
