import json

from pyspark.sql import functions as F

from corpusloom.plans import statistics
from corpusloom.sources import services


def test_crossref_items(spark, tmp_path):
    items = [
        {"DOI": "10.1/a", "title": ["T", "U"], "posted": {"date-parts": [[2020, 1]]}, "issued": {"date-parts": [[1999]]}, "author": [{"given": "A", "family": "B", "affiliation": [{"name": "X"}, {"id": 1}]}, {"family": "C"}]},
        {"DOI": "10.1/b", "issued": {"date-parts": [[1999]]}, "abstract": "<p>x</p>"},
        {"posted": {"date-parts": [[]]}, "title": []},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"message": {"items": items}}))
    got = [r.asDict(True) for r in services.crossref_items(spark, str(tmp_path / "p.json")).collect()]
    assert got == [
        {"doi": "10.1/a", "title": "T", "abstract": "", "pub_year": "2020", "authors": [{"name": "A B", "affiliations": ["X"]}, {"name": "C", "affiliations": []}]},
        {"doi": "10.1/b", "title": "", "abstract": "<p>x</p>", "pub_year": "1999", "authors": []},
        {"doi": None, "title": "", "abstract": "", "pub_year": None, "authors": []},
    ]


def test_unpaywall_urls(spark):
    place = lambda u, p: {"url": u, "url_for_pdf": p}
    texts = [json.dumps({"best_oa_location": place("b", "a"), "oa_locations": [place("b", "a"), place("d", None), place("", "c")]}), json.dumps({"best_oa_location": None, "oa_locations": []}), "no json", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(services.unpaywall_urls(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [["a", "b", "d", "c"], [], [], []]


def test_abstracts_and_subjects(spark):
    rows = [(" a \n b ", "d"), ("", "d\td"), (None, None), ("  ", "")]
    got = spark.createDataFrame(rows, "a string, d string").select(services.retrieved_abstract(F.col("a"), F.col("d")).alias("x")).collect()
    assert [r.x for r in got] == ["a b", "d d", None, None]
    answers = [{"records": [{"subjects": ["s", "t"], "keywords": ["k", "l"]}]}, {"records": [{"keyword": "one"}]}, {"records": [{"subjects": None, "keywords": [], "keyword": {"a": "x", "b": "y"}}]}, {"records": []}]
    got = spark.createDataFrame([(json.dumps(a),) for a in answers], "t string").select(*services.springer_subjects(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("s; t", "k; l"), ("", "one"), ("", "x; y"), (None, None)]


def test_titles_in_the_order_they_came(spark):
    rows = [("d", "z", 1), ("d", "a", 2), ("d", "z", 3), ("d", None, 0), ("e", None, 4), (None, "q", 5)]
    got = statistics.titles_as_seen(spark.createDataFrame(rows, "doi string, title string, n long"), "doi", "n").orderBy("doi").collect()
    assert [tuple(r) for r in got] == [("d", 4, None, 2, "z|a"), ("e", 1, None, 0, "")]
