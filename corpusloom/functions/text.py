"""Text and identifier functions as column expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() and \\s see it; Java's \\s is ASCII only.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: What \\w does not match in Python, white space apart.
PUNCT = r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"
#: The Greek letters that titles spell out.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "θ": "theta", "κ": "kappa", "λ": "lambda", "μ": "mu", "π": "pi", "σ": "sigma", "φ": "phi", "ω": "omega"}


def py_strip(x: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(x, f"^{WS}+|{WS}+$", "")


def collapse(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, f"{WS}+", " "))


def null_if_blank(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def is_missing(x: Column) -> Column:
    """Null, or nothing but white space of any script."""
    return x.isNull() | (py_strip(x) == "")


def is_filled_sql(x: Column) -> Column:
    """Not null and not only spaces: the rule of SQL TRIM, for which a line feed is content."""
    return x.isNotNull() & (F.trim(x) != "")


def doi_strict(x: Column) -> Column:
    """DOI without `doi:`, scheme, resolver, fragment and query, in lower case; '' where nothing is left (null stays null)."""
    y = py_strip(x)
    for prefix in (r"(?i)^doi:", r"(?i)^https?://", r"(?i)^(dx\.)?doi\.org/"):
        y = F.regexp_replace(py_strip(y), prefix, "")
    return F.lower(py_strip(F.split_part(F.split_part(y, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))))


def doi_loose(x: Column) -> Column:
    """DOI in lower case without one resolver or `doi:` prefix and without trailing `.,;`; null where nothing is left."""
    y = F.regexp_replace(F.lower(py_strip(x)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return null_if_blank(F.rtrim(py_strip(y), F.lit(".,;")))


def title_basic(x: Column) -> Column:
    return collapse(F.regexp_replace(F.lower(x), PUNCT, " "))


def spell_greek(x: Column) -> Column:
    """Greek letters as words of their own."""
    for letter, name in GREEK.items():
        x = F.replace(x, F.lit(letter), F.lit(f" {name} "))
    return x


def prepare(x: Column) -> Column:
    """Lower case, white space collapsed; null as ''."""
    return F.coalesce(collapse(F.lower(x)), F.lit(""))


def tidy_abstract(x: Column) -> Column:
    """As prepare(), and no space before `.,;:!?`."""
    return F.regexp_replace(prepare(x), r" +([.,;:!?])", "$1")


def strip_markup(x: Column) -> Column:
    """Text without JATS titles and tags, white space collapsed, null if nothing is left. Entities stay: see unescape()."""
    return null_if_blank(collapse(F.regexp_replace(F.regexp_replace(x, r"(?is)<jats:title[^>]*>.*?</jats:title>", " "), r"<[^>]+>", " ")))


def arxiv_id(url: Column) -> Column:
    """Last path segment of an arXiv URL without its version. Old identifiers lose their archive; see arxiv_id_full()."""
    return F.regexp_replace(F.substring_index(F.rtrim(py_strip(url), F.lit("/")), "/", -1), r"v[0-9]+$", "")


def arxiv_id_full(url: Column) -> Column:
    """Identifier with the archive of the old form (`hep-th/9901001`), which keeps different papers apart."""
    return F.regexp_replace(F.regexp_replace(F.rtrim(py_strip(url), F.lit("/")), r"^.*?/(abs|pdf)/", ""), r"v[0-9]+$", "")


def arxiv_version(url: Column) -> Column:
    return F.regexp_extract(F.substring_index(F.rtrim(py_strip(url), F.lit("/")), "/", -1), r"^.+v([0-9]+)$", 1).try_cast("int")


def first_seen(names: Column) -> Column:
    """Trimmed, non-empty elements of an array; of those equal without regard to case the first."""
    kept = F.filter(F.transform(names, lambda n: py_strip(n)), lambda n: n.isNotNull() & (n != ""))
    low = F.transform(kept, lambda n: F.lower(n))
    return F.filter(kept, lambda n, i: F.array_position(low, F.lower(n)) == i + 1)


def joined(names: Column) -> Column:
    """Elements joined by '; ', null if there are none."""
    return null_if_blank(F.array_join(names, "; "))


def crossref_authors(authors: Column) -> Column:
    """`given family`, else the literal name, of array<struct<given, family, name>>."""
    full = F.transform(authors, lambda a: F.coalesce(null_if_blank(F.concat_ws(" ", null_if_blank(py_strip(a["given"])), null_if_blank(py_strip(a["family"])))), null_if_blank(py_strip(a["name"]))))
    return joined(F.filter(full, lambda n: n.isNotNull()))


def crossref_affiliations(authors: Column) -> Column:
    """Affiliation names of array<struct<affiliation array<struct<name>>>>, each once."""
    return joined(first_seen(F.flatten(F.transform(F.coalesce(authors, F.array()), lambda a: F.coalesce(F.transform(a["affiliation"], lambda f: f["name"]), F.array().cast("array<string>"))))))


def openalex_authors(authorships: Column) -> Column:
    return joined(F.filter(F.transform(authorships, lambda a: py_strip(a["author"]["display_name"])), lambda n: n.isNotNull() & (n != "")))


def openalex_affiliations(authorships: Column) -> Column:
    """Institutions, then affiliations as printed, of each authorship; each once."""
    none = F.array().cast("array<string>")
    return joined(first_seen(F.flatten(F.transform(F.coalesce(authorships, F.array()), lambda a: F.concat(F.coalesce(F.transform(a["institutions"], lambda i: i["display_name"]), none), F.coalesce(a["raw_affiliation_strings"], none))))))


def inverted_text(index: Column) -> Column:
    """Text of a map from word to positions; null if it is empty."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return null_if_blank(F.array_join(F.transform(F.array_sort(pairs), lambda s: s["w"]), " "))


def scopus_affiliation(items: Column) -> Column:
    """`name, city, country` of each of array<struct<affilname, city, country>>."""
    return joined(F.filter(F.transform(items, lambda a: null_if_blank(F.concat_ws(", ", *(null_if_blank(py_strip(a[k])) for k in ("affilname", "city", "country"))))), lambda n: n.isNotNull()))


def paper_uid(number: Column) -> Column:
    return F.format_string("ID%09d", number)


def error_message(*parts: Column) -> Column:
    """What is known of an error, joined by ' | '."""
    return F.concat_ws(" | ", *parts)


def first_token(x: Column, sep: str = "|") -> Column:
    return F.trim(F.split_part(x, F.lit(sep), F.lit(1)))


def safe_filename(x: Column) -> Column:
    return F.translate(x, "/\\:?", "____")


def url_host(x: Column) -> Column:
    return F.regexp_extract(x, r"^https?://([^/?#]+)", 1)


def url_path(x: Column) -> Column:
    return F.regexp_extract(x, r"^https?://[^/?#]+([^?#]*)", 1)


def url_basename(x: Column) -> Column:
    return F.substring_index(url_path(x), "/", -1)


def candidates(*urls: Column) -> Column:
    """Non-empty URLs in order, each once."""
    return F.array_distinct(F.filter(F.array(*urls), lambda u: u.isNotNull() & (u != "")))


def any_of(field: str, values: Column) -> Column:
    """`field(a) OR field(b)` over an array."""
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit(f"{field}("), v, F.lit(")"))), " OR ")


def quoted_any_of(field: str, values: Column) -> Column:
    """`field:"a" OR field:"b"` with quotes and backslashes escaped."""
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit(f'{field}:"'), F.regexp_replace(v, r'(["\\])', r"\\$1"), F.lit('"'))), " OR ")


def date_window(start: Column, end: Column) -> Column:
    """`submittedDate:[a TO b]` in minutes."""
    f = "yyyyMMddHHmm"
    return F.concat(F.lit("submittedDate:["), F.date_format(start, f), F.lit(" TO "), F.date_format(end, f), F.lit("]"))


def percent_encoded(x: Column, safe: str = "/") -> Column:
    """UTF-8 bytes as %XX, but for letters, digits, `_.-~` and the safe characters."""
    out = F.replace(F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    for c in safe:
        out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return out


def publisher_query(keywords: Column, publisher: Column) -> Column:
    """`PUBLISHER(name) AND TITLE-ABS-KEY(keywords)`, either alone where the other is missing."""
    parts = F.array(F.when(~is_missing(publisher), F.concat(F.lit("PUBLISHER("), publisher, F.lit(")"))), F.when(~is_missing(keywords), F.concat(F.lit("TITLE-ABS-KEY("), keywords, F.lit(")"))))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), " AND ")


def has_abstract(x: Column) -> Column:
    """Whether there is an abstract: null, blank and 'Not Found' are none."""
    return F.coalesce(~is_missing(x) & (x != "Not Found"), F.lit(False))


def quoted_identifier(name: str) -> str:
    """An identifier quoted for SQL; a NUL can't be."""
    if "\0" in name:
        raise ValueError("an identifier holds no NUL")
    return "`" + name.replace("`", "``") + "`"


def guarded_name(name: str) -> str:
    """A table name that needs no quotes: letters, digits and underscores, no digit first."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"no table name: {name!r}")
    return name


def rstrip_lines(x: Column) -> Column:
    return F.regexp_replace(x, r"(?m)[ \t]+$", "")


def starts_with_any(x: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | x.startswith(p)
    return F.coalesce(out, F.lit(False))


def contains_ci(x: Column, word: str) -> Column:
    """Whether the word occurs, without regard to case; null text holds nothing."""
    return F.lower(F.coalesce(x, F.lit(""))).contains(word.lower())


def redact(x: Column, names: Sequence[str] = ("apikey", "api_key", "insttoken", "token", "authorization")) -> Column:
    """Values of secret parameters and headers masked."""
    return F.regexp_replace(x, rf"(?i)((?:x-els-)?(?:{'|'.join(names)})[\"']?\s*[=:]\s*[\"']?)(?:bearer\s+)?[^&\s\"',}}]+", "$1***")
