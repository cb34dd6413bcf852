"""Hooks for language models: classification and record extraction through a client that the caller gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.text import is_missing, rstrip_lines

#: The fields of the records that models are asked for. The year is text, as papers say it.
MEASURE = "struct<property_value_raw:string,property_unit:string,method:string,notes:string>"
SAMPLE = f"struct<sample_label:string,sample_aliases:array<string>,polymer_name_raw:string,polymer_abbreviation:string,architecture_raw:string,polymerization_reaction_raw:string,synthesis_procedure_text:string,glass_transition_temperatures:{MEASURE},needs_review:boolean,notes:string>"
RESULT = f"struct<paper:struct<title:string,doi:string,year:string,journal:string>,samples:array<{SAMPLE}>>"


def prompt(title: str | None, body: str | None) -> str:
    return f"Title: {title or ''}\n\n{body or ''}".strip()


def classified(papers: DataFrame, client: Callable[[list[str]], list[bool]], name: str = "is_match") -> DataFrame:
    """Papers with the verdict of `client` over batches of prompts; false without a title or abstract, and where the client fails."""

    @F.pandas_udf(BooleanType())
    def ask(title: pd.Series, abstract: pd.Series) -> pd.Series:
        try:
            return pd.Series(client([prompt(t, a) for t, a in zip(title, abstract, strict=True)]), dtype="boolean")
        except Exception:  # a model that can't be reached decides nothing
            return pd.Series([False] * len(title), dtype="boolean")

    lacks = is_missing(F.col("title")) | is_missing(F.col("abstract"))
    return papers.where(lacks).withColumn(name, F.lit(False)).unionByName(papers.where(~lacks).withColumn(name, F.coalesce(ask("title", "abstract"), F.lit(False))))


def extracted(texts: DataFrame, client: Callable[[str], str], id: str = "id") -> DataFrame:
    """(id, raw, result) of the client's JSON for each text; result is null where it isn't of the schema."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({id: frame[id], "raw": [client(t) if t else None for t in frame["text"]]})

    kind = dict(texts.dtypes)[id]
    tidy = texts.select(id, rstrip_lines(F.col("text")).alias("text"))
    return tidy.mapInPandas(run, f"{id} {kind}, raw string").withColumn("result", F.from_json("raw", RESULT))


def flattened(results: DataFrame, id: str = "id") -> DataFrame:
    """A row per sample; papers without samples keep one."""
    return results.select(id, "result.paper.*", F.explode_outer("result.samples").alias("s")).select(id, "title", "doi", "year", "journal", "s.*")
