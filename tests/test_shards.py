import gzip
import io
import random

import pytest

from corpusloom.sources import shards


def test_shards_are_checked_as_streams(spark, tmp_path):
    rng = random.Random(1)
    plain = bytes(rng.randrange(256) for _ in range(5000)) + b'{"corpusid": 1}\n' * 20000
    whole = gzip.compress(plain)
    two = gzip.compress(plain[:3000]) + gzip.compress(plain[3000:])
    at = len(whole) // 2
    made = {
        "whole": whole, "two": two, "padded": two + b"\0" * 700, "truncated": whole[:-5], "cut": two[: len(two) - 100], "flipped": whole[:at] + bytes([whole[at] ^ 4]) + whole[at + 1 :], "crc": whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:],
        "plain": plain, "trailing": whole + b"garbage", "empty": b"",
    }
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    rows = [(n, f"file://{tmp_path}/{n}", len(d)) for n, d in made.items()] + [("gone", f"file://{tmp_path}/gone", 5), ("short", f"file://{tmp_path}/whole", len(whole) + 1), ("unknown", f"file://{tmp_path}/two", None), ("null", None, 1), (None, f"file://{tmp_path}", 3)]
    verdicts = shards.checked(spark.createDataFrame(rows, "name string, path string, size long"), chunk=4096)
    got = {r.name: r for r in verdicts.collect()}
    assert {n: r.problem and r.problem.partition(":")[0] for n, r in got.items()} == {
        "whole": None, "two": None, "padded": None, "truncated": "truncated", "cut": "truncated", "flipped": "corrupt", "crc": "corrupt", "plain": "corrupt", "trailing": "corrupt", "empty": "empty",
        "gone": "missing", "short": "size", "unknown": None, "null": "missing", None: "missing",
    }
    assert (got["two"].members, got["two"].unpacked, got["two"].found) == (2, len(plain), len(two)) and got["gone"].found is None
    assert {r.problem: (r.files, r.first) for r in shards.report(verdicts).collect()} == {"none": (4, "padded"), "truncated": (2, "cut"), "corrupt": (4, "crc"), "missing": (3, "gone"), "size": (1, "short"), "empty": (1, "empty")}
    assert shards.checked(spark.createDataFrame([], "name string, path string, size long")).collect() == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_any_chunk_says_the_same(chunk):
    data = gzip.compress(b"abc" * 500) + gzip.compress(b"") + gzip.compress(b"x" * 100_000)
    assert shards.gzip_problem(io.BytesIO(data), chunk) == (len(data), 3, 101_500, None)
    for end in (1, 9, len(data) // 2, len(data) - 1):
        assert shards.gzip_problem(io.BytesIO(data[:end]), chunk)[3] in ("truncated", None) and (end == len(data) // 2 or shards.gzip_problem(io.BytesIO(data[:end]), chunk)[3] == "truncated")


def test_a_small_shard_that_unpacks_to_much():
    data = gzip.compress(b"\0" * (64 << 20))
    assert shards.gzip_problem(io.BytesIO(data)) == (len(data), 1, 64 << 20, None)
