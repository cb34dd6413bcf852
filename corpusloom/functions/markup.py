"""XML records and file checks. Spark's xpath fails on malformed input, so documents are parsed in Arrow-batched UDFs that never do."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType

from .pdf import pdf_verdict



def fields(**kinds: DataType) -> StructType:
    """A struct type, made without a session: executors import this module too."""
    return StructType([StructField(n, k) for n, k in kinds.items()])


STRING, WHOLE = StringType(), LongType()
ARXIV = fields(
    arxiv_id=STRING, version=IntegerType(), arxiv_url=STRING, doi=STRING, title=STRING, abstract=STRING, authors=STRING, affiliation=STRING, primary_category=STRING, categories=STRING, published=STRING, updated=STRING,
    journal_ref=STRING, comment=STRING, pdf_url=STRING,
)
FEED = fields(total=WHOLE, start=WHOLE, per_page=WHOLE, error=STRING, entries=ArrayType(ARXIV))
CHECK = fields(ok=BooleanType(), reason=STRING)


def name(el: ET.Element) -> str:
    return el.tag.rsplit("}", 1)[-1] if isinstance(el.tag, str) else ""


def kids(el: ET.Element, tag: str) -> list[ET.Element]:
    return [x for x in el if name(x) == tag]


def said(el: ET.Element | None) -> str | None:
    text = " ".join("".join(el.itertext()).split()) if el is not None else ""
    return text or None


def one(el: ET.Element, tag: str) -> str | None:
    return next((t for x in kids(el, tag) if (t := said(x))), None)


def parse(text: str | bytes | None) -> ET.Element | None:
    try:
        return ET.fromstring(text) if text else None
    except ET.ParseError:
        return None


def arxiv_entry(entry: ET.Element) -> dict:
    url = one(entry, "id")
    last = (url or "").rstrip("/").rsplit("/", 1)[-1]
    m = re.fullmatch(r"(.+)v(\d+)", last)
    authors = kids(entry, "author")
    places = dict.fromkeys(t for a in authors for f in kids(a, "affiliation") if (t := said(f)))
    links = kids(entry, "link")
    return {
        "arxiv_id": (m[1] if m else last) or None, "version": int(m[2]) if m else None, "arxiv_url": url, "doi": one(entry, "doi"), "title": one(entry, "title"), "abstract": one(entry, "summary"),
        "authors": "; ".join(t for a in authors if (t := one(a, "name"))) or None, "affiliation": "; ".join(places) or None,
        "primary_category": next((x.get("term") for x in kids(entry, "primary_category")), None), "categories": " ".join(t for x in kids(entry, "category") if (t := x.get("term"))) or None,
        "published": one(entry, "published"), "updated": one(entry, "updated"), "journal_ref": one(entry, "journal_ref"), "comment": one(entry, "comment"),
        "pdf_url": next((x.get("href") for x in links if x.get("title") == "pdf" or x.get("type") == "application/pdf"), None),
    }


def _feed(text: str | None) -> dict:
    root = parse(text)
    if root is None:
        return {"total": None, "start": None, "per_page": None, "error": "malformed feed", "entries": []}
    number = lambda tag: int(t) if (t := one(root, tag)) and t.isdigit() else None
    found = kids(root, "entry")
    error = next((one(e, "summary") or "error" for e in found if one(e, "title") == "Error" or "/api/errors" in (one(e, "id") or "")), None)
    return {"total": number("totalResults"), "start": number("startIndex"), "per_page": number("itemsPerPage"), "error": error, "entries": [] if error else [arxiv_entry(e) for e in found]}


@F.pandas_udf(FEED)
def atom_feed(text: pd.Series) -> pd.DataFrame:
    """Totals, error and entries of an arXiv Atom feed."""
    return pd.DataFrame([_feed(t) for t in text], columns=FEED.names)


def jats_doi(record: ET.Element) -> str | None:
    """DOI of an article or book part: its own metadata first, then the book part's, then any identifier."""
    for test in (lambda e: name(e) == "article-id" and e.get("pub-id-type") == "doi", lambda e: name(e) in ("book-part-id", "book-id") and (e.get("book-part-id-type") or e.get("book-id-type")) == "doi", lambda e: e.get("pub-id-type") == "doi"):
        if found := next((t for e in record.iter() if test(e) and (t := said(e))), None):
            return found
    return None


@F.pandas_udf(ArrayType(fields(doi=STRING, xml=STRING)))
def jats_records(text: pd.Series) -> pd.Series:
    """Articles and book parts of a batch response, with their DOIs; none if it is malformed."""

    def records(t: str | None) -> list[dict]:
        root = parse(t)
        found = [] if root is None else [e for e in root.iter() if name(e) in ("article", "book-part-wrapper")]
        return [{"doi": jats_doi(e), "xml": ET.tostring(e, encoding="unicode")} for e in found]

    return text.map(records)


@F.pandas_udf(fields(code=STRING, message=STRING))
def service_error(text: pd.Series) -> pd.DataFrame:
    """Status of a service-error document, nulls if it is none."""
    rows = []
    for t in text:
        root = parse(t)
        status = next((e for e in root.iter() if name(e) == "status"), None) if root is not None and name(root) == "service-error" else None
        rows.append((None, None) if status is None else (one(status, "statusCode"), one(status, "statusText")))
    return pd.DataFrame(rows, columns=["code", "message"])


@F.pandas_udf(STRING)
def pmcid(text: pd.Series) -> pd.Series:
    """PMCID of a JATS article, with its prefix."""

    def found(t: str | None) -> str | None:
        root = parse(t)
        ids = [] if root is None else [s for e in root.iter() if name(e) == "article-id" and e.get("pub-id-type") in ("pmcid", "pmc") and (s := said(e))]
        return None if not ids else ids[0] if ids[0].upper().startswith("PMC") else f"PMC{ids[0]}"

    return text.map(found)


@F.pandas_udf(CHECK)
def valid_pdf(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([pdf_verdict(d) for d in data], columns=["ok", "reason"])


@F.pandas_udf(CHECK)
def valid_fulltext(text: pd.Series) -> pd.DataFrame:
    """A full-text response whose root and originalText are there."""

    def verdict(t: str | None) -> tuple[bool, str | None]:
        root = parse(t)
        if root is None:
            return False, "malformed XML"
        if name(root) != "full-text-retrieval-response":
            return False, f"unexpected root {name(root)}"
        return (True, None) if any(name(e) == "originalText" for e in root.iter()) else (False, "no originalText")

    return pd.DataFrame([verdict(t) for t in text], columns=["ok", "reason"])


@F.pandas_udf(CHECK)
def valid_article(text: pd.Series, wanted: pd.Series) -> pd.DataFrame:
    """A JATS article whose PMCID is the wanted one."""

    def verdict(t: str | None, w: str | None) -> tuple[bool, str | None]:
        root = parse(t)
        if root is None:
            return False, "malformed XML"
        if name(root) != "article":
            return False, f"unexpected root {name(root)}"
        ids = {(said(e) or "").upper().removeprefix("PMC") for e in root.iter() if name(e) == "article-id" and e.get("pub-id-type") in ("pmcid", "pmc")}
        return (True, None) if (w or "").upper().removeprefix("PMC") in ids else (False, "PMCID mismatch")

    return pd.DataFrame([verdict(t, w) for t, w in zip(text, wanted, strict=True)], columns=["ok", "reason"])


@F.pandas_udf(CHECK)
def valid_jats(text: pd.Series, wanted: pd.Series) -> pd.DataFrame:
    """An article or book part whose DOI is the wanted one, without regard to case."""

    def verdict(t: str | None, w: str | None) -> tuple[bool, str | None]:
        root = parse(t)
        if root is None:
            return False, "malformed XML"
        if name(root) not in ("article", "book-part-wrapper"):
            return False, f"unexpected root {name(root)}"
        doi = jats_doi(root)
        if not doi:
            return False, "no DOI"
        return (True, None) if doi.casefold() == (w or "").casefold() else (False, "DOI mismatch")

    return pd.DataFrame([verdict(t, w) for t, w in zip(text, wanted, strict=True)], columns=["ok", "reason"])
