"""A search service of three pages, for the cursor source."""

from pathlib import Path

PAGES = {"*": (['{"a":1}', '{"a":2}'], "c1"), "c1": (['{"a":3}'], "c2"), "c2": ([], "c3")}


def fetch(query, cursor):
    return PAGES[cursor] if query != "same" else (['{"a":9}'], cursor)


def fetch_marked(query, cursor):
    """Fails behind the first page of a query `fails|file` as long as the file is there."""
    kind, _, mark = query.partition("|")
    if kind == "fails" and cursor == "c1" and Path(mark).exists():
        raise ConnectionError("down")
    return PAGES[cursor]
