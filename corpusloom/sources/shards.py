"""Landed gzip shards: sizes and checksums, told by executors that stream each file, without reading it as rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that are read, and that are unpacked, at once.
CHUNK = 1 << 20
CHECKED = "name string, path string, size long, found long, members long, unpacked long, problem string"


def gzip_problem(stream, chunk: int = CHUNK) -> tuple[int, int, int, str | None]:
    """Bytes, members and unpacked bytes of a gzip file, and what is wrong with it: `empty`, `truncated`, `corrupt` (with zlib's words) or None.

    Every member's checksum and length are compared; zeros behind the last one are padding. Memory is two chunks.
    """
    size = members = unpacked = 0
    member = None
    try:
        while data := stream.read(chunk):
            size += len(data)
            while data:
                if member is None:
                    if members and not data.strip(b"\0"):
                        break
                    member = zlib.decompressobj(zlib.MAX_WBITS | 16)
                unpacked += len(member.decompress(data, chunk))
                data = member.unused_data if member.eof else member.unconsumed_tail
                if member.eof:
                    members, member = members + 1, None
    except zlib.error as e:
        return size, members, unpacked, f"corrupt: {e}"
    return size, members, unpacked, "empty" if not size else "truncated" if member is not None else None


def checked(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """files(name, path, size) with what was found: bytes, members, unpacked bytes and a problem, or null.

    `missing`: no such file or a null path; `size`: not the bytes that the manifest says (a null size isn't compared); else as gzip_problem() has it. Every file is read once, by one
    task and in chunks. Paths are of stores that pyarrow opens. Repeated rows are each checked; no rows give none.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, path, size in frame.itertuples(index=False):
                found, members, unpacked, problem = None, None, None, "missing"
                if isinstance(path, str):
                    store, at = pyarrow.fs.FileSystem.from_uri(path)
                    if store.get_file_info(at).type == pyarrow.fs.FileType.File:
                        with store.open_input_stream(at, compression=None, buffer_size=chunk) as stream:
                            found, members, unpacked, problem = gzip_problem(stream, chunk)
                        if not pd.isna(size) and found != size:
                            problem = "size" if problem is None else problem
                out.append((name, path, size, found, members, unpacked, problem))
            made = pd.DataFrame(out, columns=[c.split()[0] for c in CHECKED.split(", ")])
            yield made.astype({c: "Int64" for c in ("size", "found", "members", "unpacked")})

    rows = files.select(F.col("name").cast("string").alias("name"), F.col("path").cast("string").alias("path"), F.col("size").cast("long").alias("size"))
    return rows.repartition("path").mapInPandas(run, CHECKED)


def report(verdicts: DataFrame) -> DataFrame:
    """problem, files, bytes and the first name of each kind of outcome; whole files are `none`."""
    kind = F.coalesce(F.substring_index("problem", ":", 1), F.lit("none"))
    return verdicts.groupBy(kind.alias("problem")).agg(F.count("*").alias("files"), F.coalesce(F.sum("found"), F.lit(0)).alias("bytes"), F.min("name").alias("first"))
