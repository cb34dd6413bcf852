"""Pages that end inside an entity, against the SQL of the queries that resolve entities."""

import duckdb
import pytest

from corpusloom.queries import ORACLES, QUERIES

PAGES = [
    (1, "/1", "<html><title>One two&amp</title><p>a &amp; b &ltc &quot;q&quot; &copy; &copyright</p>"),
    (2, "/2", "<title>&amp</title>x&am"),
    (3, "/3", "<title>Plain &copy; &gt; title</title>&lt;i&gt; &amp;amp &amp;lt; &middot;"),
    (4, "/4", "<title>no end</title>a && b &; &"),
]


@pytest.mark.parametrize("name", ["clean_abstracts", "normalize_title_full"])
def test_entities_without_semicolon(spark, tmp_path, name):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = dict(con.execute(ORACLES[name]).fetchall())
    assert len(want) == len(PAGES) and {r[0]: r[1] for r in QUERIES[name](spark, str(tmp_path)).collect()} == want
