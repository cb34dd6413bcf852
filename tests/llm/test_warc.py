import gzip
import hashlib
import io
import os
import random

from corpusloom.llm.warc import archive_digests, info, member, members, op4_warc, read_warc, write_warc

from .conftest import DATA


def brute(rows):
    first = {}
    for page, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        to = first.get(raw)
        again = to is not None and to != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    assert sorted(map(tuple, op4_warc(spark, DATA).collect()), key=str) == brute(pages)


def test_payloads_survive_and_repeats_are_revisits(spark, tmp_path):
    long = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    rows = [(5, "u\r\nX-Page-Id: 9", long), (3, None, long), (4, "é", "é" * 60), (9, "e", "é" * 60), (1, "s", "s"), (2, "s", "s"), (None, "n", None), (7, "t", "t" * 99), (8, "t", "t" * 99), (3, None, long)]
    df = spark.createDataFrame([(*r, "y") for r in rows], "page_id long, url string, html string, digest string")
    for compression in ("gzip", "none"):
        path = f"file://{tmp_path}/{compression}"
        write_warc(df, path, compression=compression, file_bytes=600)
        assert sorted(map(tuple, archive_digests(spark, path).collect()), key=str) == brute([(r[0], r[2]) for r in rows])
        got = read_warc(spark, path).where("warc_type = 'response'").select("page_id", "payload").collect()
        assert sorted(((r.page_id, r.payload) for r in got), key=str) == sorted([(3, long), (3, long), (4, "é" * 60), (1, "s"), (2, "s"), (None, ""), (7, "t" * 99), (8, "t" * 99)], key=str)
        one = read_warc(spark, path, "none").where("page_id in (4, 9) and target_uri like 'e%'").select("page_id", "payload", "refers_to_page")
        assert [tuple(r) for r in one.collect()] == [(9, None, 4)]
    write_warc(df.limit(0), f"file://{tmp_path}/empty")
    assert read_warc(spark, f"file://{tmp_path}/empty").count() == 0


def test_predicates_reach_the_reader(spark, tmp_path):
    write_warc(spark.read.parquet(f"{DATA}/pages.parquet"), f"file://{tmp_path}/w")
    df = read_warc(spark, f"file://{tmp_path}/w").where("warc_type = 'revisit'")
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any(line.strip("+-:* ()0123456789").startswith("Filter") for line in plan)


def test_passed_over_payloads_are_not_inflated():
    rng = random.Random(1)
    noise = "".join(rng.choice("0123456789abcdef") for _ in range(3_000_000))
    said = lambda i, kind: f"WARC/1.1\r\nWARC-Type: {kind}\r\nX-Page-Id: {i}\r\nContent-Length: {len(noise)}\r\n\r\n{noise}\r\n\r\n".encode()
    raw = b"".join(member(said(i, "response" if i else "metadata")) for i in range(3))

    class Counting(io.BytesIO):
        total = 0

        def read(self, n=-1):
            got = super().read(n)
            Counting.total += len(got)
            return got

    rows = list(members(Counting(raw), lambda r: r["page_id"] == 2, "digest"))
    assert [(r["page_id"], r["read_bytes"], r["read_digest"]) for r in rows] == [(2, len(noise), hashlib.sha256(noise.encode()).hexdigest())]
    assert Counting.total < 0.4 * len(raw)
    Counting.total = 0
    assert len(list(members(Counting(raw), lambda r: True, "none"))) == 3 and Counting.total < 0.05 * len(raw)
    assert gzip.decompress(raw) == b"".join(said(i, "response" if i else "metadata") for i in range(3))


def test_archives_packed_as_a_whole_are_read(spark, tmp_path):
    write_warc(spark.read.parquet(f"{DATA}/pages.parquet"), f"file://{tmp_path}/one", compression="none")
    (tmp_path / "two").mkdir()
    for f in os.listdir(tmp_path / "one"):
        (tmp_path / "two" / f"{f}.gz").write_bytes(gzip.compress((tmp_path / "one" / f).read_bytes()))
    assert sorted(map(tuple, archive_digests(spark, f"file://{tmp_path}/two").collect()), key=str) == sorted(map(tuple, op4_warc(spark, DATA).collect()), key=str)
    assert not list((tmp_path / "one").glob("_writing*")) and info("2024-01-01T00:00:00Z").startswith(b"WARC/1.1")


def test_very_long_page(spark, tmp_path):
    rows = [(1, "u", "long " * 3_000_000), (2, "v", "long " * 3_000_000), (3, "w", "")]
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w")
    assert sorted(map(tuple, archive_digests(spark, f"file://{tmp_path}/w").collect()), key=str) == brute([(r[0], r[2]) for r in rows])
