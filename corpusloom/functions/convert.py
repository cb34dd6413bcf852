"""Conversions between text and typed values; every tolerant parse gives null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

STRINGS = "array<string>"
#: An attempt, as the download history keeps it.
HISTORY = "array<struct<source:string,status:string,error:string,attempt:int,timestamp:string>>"


def yes_flag(x: Column) -> Column:
    """'Y' as 1, other text as 0, null as null."""
    return F.when(x.isNotNull(), (x == "Y").cast("int"))


def whole_number(x: Column) -> Column:
    return py_strip(x).try_cast("bigint")


def flag(x: Column) -> Column:
    return x.cast("int")


def open_access(text: Column, mark: Column) -> Column:
    """One boolean of a text flag ('1', 'true') and a boolean-like text."""
    true = lambda c: F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "t", "yes", "y"), F.lit(False))
    return true(text) | true(mark)


def string_list(x: Column) -> Column:
    """JSON list of strings; empty for null, '' and anything else."""
    return F.coalesce(F.from_json(F.when(F.trim(x).startswith("["), x), STRINGS), F.array().cast(STRINGS))


def list_text(x: Column) -> Column:
    return F.to_json(x)


def has_history(x: Column) -> Column:
    """Whether a history says anything; text that isn't JSON counts as something."""
    return ~F.coalesce(F.lower(py_strip(x)).isin("", "[]", "null", "none"), F.lit(True))


def history(x: Column) -> Column:
    """Attempts of a history; null if it isn't a list."""
    return F.from_json(F.when(F.try_parse_json(x).isNotNull() & F.trim(x).startswith("["), x), HISTORY)


def history_length(x: Column) -> Column:
    parsed = history(x)
    return F.when(has_history(x), F.when(parsed.isNotNull(), F.size(parsed))).otherwise(0)


def history_agrees(x: Column, attempts: Column) -> Column:
    """Whether a history lists as many attempts as were counted; one that can't be read doesn't."""
    return F.coalesce(history_length(x) == attempts, F.lit(False))


def append_attempt(items: Column, source: Column, status: Column, error: Column, attempt: Column, at: Column) -> Column:
    return F.array_append(items, F.struct(source.alias("source"), status.alias("status"), error.alias("error"), attempt.cast("int").alias("attempt"), at.alias("timestamp")))


def epoch_iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def now_iso(clock: Column | None = None) -> Column:
    """The time, or that of `clock`, as ISO seconds in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if clock is None else clock, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def minute_time(x: Column) -> Column:
    return F.try_to_timestamp(x, F.lit("yyyyMMddHHmm"))


def iso_time(x: Column) -> Column:
    return F.try_to_timestamp(x)


def parts_year(date_parts: Column) -> Column:
    """Year of Crossref's [[year, month, day]]."""
    return F.try_element_at(F.try_element_at(date_parts, F.lit(1)), F.lit(1))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits).cast("double")


def http_outcome(code: Column, kind: str = "DOI") -> Column:
    """Outcome name of an HTTP status; `kind` names the identifier that is unknown or invalid."""
    return (
        F.when(code.between(200, 299), "SUCCESS").when(code == 400, f"INVALID_{kind}").when(code.isin(401, 403), "ACCESS_DENIED").when(code == 404, f"UNKNOWN_{kind}")
        .when(code == 429, "RATE_LIMITED").when(code >= 500, "SERVER_ERROR").when(code.isNull(), "NETWORK_ERROR").otherwise("OTHER_ERROR")
    )


def header_int(headers: Column, name: str) -> Column:
    """Whole number of a header, whose name may be in any case."""
    found = F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name.lower()))
    return F.try_element_at(found, F.lit(1)).try_cast("bigint")


def search_counters(results: Column) -> list[Column]:
    """OpenSearch totals of a search-results object in JSON."""
    return [F.get_json_object(results, f"$['search-results']['opensearch:{name}']").try_cast("bigint").alias(alias) for name, alias in (("totalResults", "total_results"), ("startIndex", "start_index"), ("itemsPerPage", "items_per_page"))]
