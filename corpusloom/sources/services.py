"""Records of services that are looked at now and then, as captured pages: Crossref listings, Unpaywall, Scopus abstracts, Springer's open-access search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapse

DATES = "struct<`date-parts`:array<array<int>>>"
ITEMS = f"message struct<items:array<struct<DOI:string,title:array<string>,abstract:string,posted:{DATES},issued:{DATES},author:array<struct<given:string,family:string,affiliation:array<struct<name:string>>>>>>>"
PLACE = "struct<url:string,url_for_pdf:string>"
UNPAYWALL = f"best_oa_location {PLACE}, oa_locations array<{PLACE}>"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def crossref_items(spark: SparkSession, path: str) -> DataFrame:
    """doi, title, abstract, pub_year and authors(name, affiliations) of listed works. Preprints have a posted date, others an issued one; missing texts are empty, affiliations without a name left out."""
    item = spark.read.schema(ITEMS).option("multiLine", True).json(path).select(F.explode("message.items").alias("i"))
    date = F.coalesce(F.col("i.posted"), F.col("i.issued"))
    year = F.try_element_at(F.try_element_at(date["date-parts"], F.lit(1)), F.lit(1)).cast("string")
    author = lambda a: F.struct(
        F.trim(F.concat(_or_empty(a["given"]), F.lit(" "), _or_empty(a["family"]))).alias("name"),
        F.array_compact(F.transform(F.coalesce(a["affiliation"], F.array().cast("array<struct<name:string>>")), lambda x: x["name"])).alias("affiliations"),
    )
    authors = F.coalesce(F.transform("i.author", author), F.array().cast("array<struct<name:string,affiliations:array<string>>>"))
    return item.select(F.col("i.DOI").alias("doi"), _or_empty(F.try_element_at("i.title", F.lit(1))).alias("title"), _or_empty(F.col("i.abstract")).alias("abstract"), year.alias("pub_year"), authors.alias("authors"))


def unpaywall_urls(answer: Column) -> Column:
    """URLs of an answer in JSON, each once: those of the best place first, and of each place the PDF's before the page's. Empty if it can't be read."""
    parsed = F.from_json(answer, UNPAYWALL)
    of = lambda p: F.array(p["url_for_pdf"], p["url"])
    places = F.flatten(F.transform(F.coalesce(parsed["oa_locations"], F.array().cast(f"array<{PLACE}>")), of))
    return F.array_distinct(F.filter(F.concat(of(parsed["best_oa_location"]), places), lambda u: u.isNotNull() & (u != "")))


def retrieved_abstract(abstract: Column, description: Column) -> Column:
    """The abstract, or else the description, in one line; null where there is neither."""
    given = lambda c: F.when(c != "", c)
    return F.nullif(collapse(F.coalesce(given(abstract), given(description))), F.lit(""))


def _texts(value: Column) -> Column:
    """A JSON value as texts: the items of a list, the values of an object, or the text itself."""
    listed = F.when(value.startswith("["), F.from_json(value, "array<string>")).when(value.startswith("{"), F.map_values(F.from_json(value, "map<string,string>"))).otherwise(F.array(value))
    return F.coalesce(F.when(value.isNotNull() & (value != ""), listed), F.array().cast("array<string>"))


def springer_subjects(answer: Column) -> list[Column]:
    """springer_subjects and springer_keywords of the first record, joined by `; `. Keywords are a list, an object or one text, under either of two names."""
    of = lambda name: F.get_json_object(answer, f"$.records[0].{name}")
    found = lambda c: F.when(F.size(_texts(c)) > 0, c)
    there = F.get_json_object(answer, "$.records[0]").isNotNull()
    words = F.coalesce(found(of("keywords")), found(of("keyword")))
    return [F.when(there, F.array_join(_texts(c), "; ")).alias(n) for n, c in (("springer_subjects", of("subjects")), ("springer_keywords", words))]
