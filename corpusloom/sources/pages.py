"""A Python data source for cursor-paged search services, with the service itself behind a function that the caller names.

`spark.read.format("cursorpages").option("fetch", "module:function").option("queries", json_list)`: fetch(query, cursor) gives (records as JSON texts, next cursor). A
partition follows one query's cursor, so date buckets or publishers are read side by side.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class Query(InputPartition):
    text: str


class CursorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.fetch, self.first = options["fetch"], options.get("start", "*")
        self.queries = json.loads(options["queries"])
        self.most = int(options.get("maxPages", 0))

    def partitions(self) -> list[Query]:
        return [Query(q) for q in self.queries] or [Query("")]

    def read(self, partition: Query) -> Iterator[tuple]:
        """Pages until one is empty, names no next cursor or the same again, or `maxPages` are read."""
        if not partition.text:
            return
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        cursor, page = self.first, 0
        while cursor and (not self.most or page < self.most):
            records, after = fetch(partition.text, cursor)
            if not records:
                return
            for r in records:
                yield partition.text, page, cursor, r
            if after == cursor:
                return
            cursor, page = after, page + 1


class ResumableReader(DataSourceReader):
    """Pages of each query from its own cursor on; a failure is a row, so that what came before it is kept."""

    def __init__(self, options: dict):
        self.fetch, self.resume = options["fetch"], json.loads(options["resume"])
        self.most = int(options.get("maxPages", 0))

    def partitions(self) -> list[Query]:
        return [Query(q) for q in self.resume] or [Query("")]

    def read(self, partition: Query) -> Iterator[tuple]:
        if not partition.text:
            return
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        cursor, page = self.resume[partition.text], 0
        while not self.most or page < self.most:
            try:
                records, after = fetch(partition.text, cursor)
            except Exception as e:
                yield partition.text, page, cursor, cursor, False, None, f"{type(e).__name__}: {e}"
                return
            finished = not records or not after or after == cursor
            for r in records or [None]:
                yield partition.text, page, cursor, after, finished, r, None
            if finished:
                return
            cursor, page = after, page + 1


class ResumablePages(DataSource):
    """`spark.read.format("resumablepages")` with options fetch, resume (JSON of query to cursor) and maxPages."""

    @classmethod
    def name(cls) -> str:
        return "resumablepages"

    def schema(self) -> str:
        return "query string, page int, cursor string, next string, finished boolean, record string, error string"

    def reader(self, schema) -> ResumableReader:
        return ResumableReader(self.options)


class CursorPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cursorpages"

    def schema(self) -> str:
        return "query string, page int, cursor string, record string"

    def reader(self, schema) -> CursorReader:
        return CursorReader(self.options)
