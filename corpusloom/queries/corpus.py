"""Registry, statistics, filters, joins, deduplication and changes over documents and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.convert import percent
from ..functions.text import is_filled_sql
from ..operators import dedup, dml, filters, joins, numbering, setops
from ..plans import quality, registry, statistics
from .staging import papers, read, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, staged: bool = True):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = sql(oracle) if staged else oracle
        return fn

    return register


MERGED = """, u AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY identifier_key, source ORDER BY staging_id) = 1),
base AS (SELECT identifier_key, max(doi) AS doi, max(arxiv_id) AS arxiv_id, min(identifier_type) AS identifier_type, min(identifier_value) AS identifier_value, count(*) AS source_count FROM u GROUP BY 1),
canon AS (SELECT identifier_key, source FROM u QUALIFY row_number() OVER (PARTITION BY identifier_key ORDER BY source_priority, source) = 1),
t AS (SELECT identifier_key, title FROM u QUALIFY row_number() OVER (PARTITION BY identifier_key ORDER BY CASE WHEN trim(coalesce(title, '')) = '' THEN 1 ELSE 0 END, source_priority, source) = 1),
a AS (SELECT identifier_key, abstract FROM u QUALIFY row_number() OVER (PARTITION BY identifier_key ORDER BY CASE WHEN trim(coalesce(abstract, '')) = '' THEN 1 ELSE 0 END, source_priority, source) = 1),
l AS (SELECT identifier_key, '["' || string_agg(source, '","' ORDER BY source_priority, source) || '"]' AS sources FROM u GROUP BY 1),
merged AS (SELECT row_number() OVER (ORDER BY CASE identifier_type WHEN 'doi' THEN 0 ELSE 1 END, identifier_value) AS paper_id, base.*, t.title, a.abstract, l.sources, canon.source AS canonical_source
  FROM base JOIN canon USING (identifier_key) JOIN l USING (identifier_key) LEFT JOIN t USING (identifier_key) LEFT JOIN a USING (identifier_key))
"""


@query(MERGED + "SELECT CAST(paper_id AS BIGINT) AS paper_id, printf('ID%09d', paper_id) AS paper_uid, identifier_type, identifier_value, doi, arxiv_id, title, abstract, sources, source_count, sources AS source_order, canonical_source, 1 AS canonical_source_position, 'pending' AS download_status, 0 AS attempt_count, '[]' AS attempted_sources, '[]' AS failure_history FROM merged")
def registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.merged(papers(spark, sf_dir))


FAULTY = """, f AS (SELECT paper_id, CASE WHEN paper_id % 29 = 0 THEN 'ID000000000' ELSE printf('ID%09d', paper_id) END AS paper_uid, identifier_type, arxiv_id, sources, sources AS source_order,
  CASE WHEN paper_id % 11 = 0 THEN ' ' ELSE identifier_value END AS identifier_value, CASE WHEN paper_id % 13 = 0 THEN '10.1/same' ELSE doi END AS doi, CASE WHEN paper_id % 17 = 0 THEN ' ' ELSE canonical_source END AS canonical_source,
  source_count + CASE WHEN paper_id % 19 = 0 THEN 1 ELSE 0 END AS source_count, CASE WHEN paper_id % 23 = 0 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN paper_id % 31 = 0 THEN 2 ELSE 0 END AS attempts FROM merged),
c AS (SELECT 'missing_identifier' AS "check", count(*) FILTER (trim(coalesce(identifier_value, '')) = '' OR identifier_type IS NULL) AS issue_count FROM f
  UNION ALL SELECT 'inconsistent_identifier', count(*) FILTER (identifier_type = 'doi' AND doi IS DISTINCT FROM identifier_value OR identifier_type = 'arxiv_id' AND arxiv_id IS DISTINCT FROM identifier_value) FROM f
  UNION ALL SELECT 'missing_canonical_source', count(*) FILTER (trim(coalesce(canonical_source, '')) = '') FROM f
  UNION ALL SELECT 'wrong_source_count', count(*) FILTER (len(string_split(sources, ',')) <> source_count) FROM f
  UNION ALL SELECT 'wrong_initial_status', count(*) FILTER (status <> 'pending' OR attempts <> 0) FROM f
  UNION ALL SELECT 'order_not_canonical', count(*) FILTER (NOT starts_with(source_order, '["' || canonical_source || '"')) FROM f
  UNION ALL SELECT 'duplicate_uid', count(*) FROM (SELECT paper_uid FROM f GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'duplicate_identifier', count(*) FROM (SELECT identifier_type, identifier_value FROM f GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'duplicate_doi', count(*) FROM (SELECT doi FROM f WHERE doi IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
"""


def faulty(df: DataFrame) -> DataFrame:
    """A registry with faults at known papers, which the checks have to find."""
    i = F.col("paper_id")
    swapped = {"paper_uid": (29, F.lit("ID000000000")), "identifier_value": (11, F.lit(" ")), "doi": (13, F.lit("10.1/same")), "canonical_source": (17, F.lit(" ")), "source_count": (19, F.col("source_count") + 1), "download_status": (23, F.lit("failed")), "attempt_count": (31, F.lit(2))}
    return df.withColumns({c: F.when(i % n == 0, x).otherwise(F.col(c)) for c, (n, x) in swapped.items()})


@query(MERGED + FAULTY + 'SELECT "check", issue_count, issue_count = 0 AS passed FROM c')
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.checks(faulty(registry.merged(papers(spark, sf_dir))))


@query("SELECT source, count(*) AS records, count(*) FILTER (title IS NOT NULL AND trim(title) <> '') AS with_title, count(DISTINCT lower(trim(identifier_value))) AS unique_values, count(*) FILTER (doi IS NULL) AS missing_doi, count(DISTINCT doi) AS unique_dois FROM papers GROUP BY source")
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.per_source(papers(spark, sf_dir))


@query("SELECT count(*) AS groups_found FROM (SELECT identifier_key FROM papers GROUP BY 1 HAVING count(*) > 1)")
def duplicate_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(papers(spark, sf_dir), "identifier_key").select(F.col("issue_count").alias("groups_found"))


@query("SELECT count(*) AS total, count(doi) AS with_doi, count(*) FILTER (identifier_type = 'arxiv_id') AS arxiv_rows, count(*) FILTER (trim(coalesce(title, '')) = '') AS blank_titles, max(source_priority) AS worst_priority, count(DISTINCT CASE WHEN identifier_type = 'doi' THEN identifier_value END) AS distinct_dois FROM papers")
def staging_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.summary(papers(spark, sf_dir))


@query("SELECT source, count(DISTINCT identifier_key) AS papers, count(DISTINCT doi) AS dois, count(DISTINCT arxiv_id) AS arxiv_ids, count(DISTINCT title) AS titles FROM papers GROUP BY source")
def source_unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).groupBy("source").agg(F.countDistinct("identifier_key").alias("papers"), F.countDistinct("doi").alias("dois"), F.countDistinct("arxiv_id").alias("arxiv_ids"), F.countDistinct("title").alias("titles"))


@query(", k AS (SELECT identifier_key, count(DISTINCT source) AS n FROM papers GROUP BY 1) SELECT count(*) FILTER (n = 1) AS single, count(*) FILTER (n >= 2) AS shared, max(n) AS most FROM k")
def overlap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.overlap(papers(spark, sf_dir))


@query(", k AS (SELECT identifier_key, count(DISTINCT source) AS n FROM papers GROUP BY 1) SELECT n AS source_count, count(*) AS papers, round(100.0 * count(*) / (SELECT count(*) FROM k), 2)::DOUBLE AS share FROM k GROUP BY n")
def source_count_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.source_counts(papers(spark, sf_dir))


@query(", d AS (SELECT DISTINCT identifier_key, source, source_priority FROM papers) SELECT combination, count(*) AS papers FROM (SELECT string_agg(source, ' -> ' ORDER BY source_priority, source) AS combination FROM d GROUP BY identifier_key) GROUP BY 1")
def source_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.combinations(papers(spark, sf_dir))


@query(MERGED + "SELECT canonical_source, count(*) AS papers, round(100.0 * count(*) / (SELECT count(*) FROM merged), 2)::DOUBLE AS share FROM merged GROUP BY 1")
def canonical_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.shares(registry.assembled(papers(spark, sf_dir)), "canonical_source")


@query(MERGED + ", s AS (SELECT source_count, canonical_source FROM merged) SELECT canonical_source, source_count, count(*) AS papers FROM s GROUP BY 1, 2")
def source_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.assembled(papers(spark, sf_dir)).groupBy("canonical_source", "source_count").agg(F.count("*").alias("papers"))


@query(", d AS (SELECT DISTINCT identifier_key, source FROM papers), s AS (SELECT DISTINCT source FROM d), n AS (SELECT a.source AS source_a, b.source AS source_b, count(*) AS shared FROM d a JOIN d b USING (identifier_key) WHERE a.source < b.source GROUP BY 1, 2) SELECT x.source AS source_a, y.source AS source_b, coalesce(n.shared, 0) AS shared FROM s x JOIN s y ON x.source < y.source LEFT JOIN n ON n.source_a = x.source AND n.source_b = y.source")
def pairwise_source_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pair_overlap(papers(spark, sf_dir))


@query("SELECT n AS copies, count(*) AS groups FROM (SELECT count(*) AS n FROM papers GROUP BY identifier_key HAVING count(*) > 1) GROUP BY n")
def dup_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.multiplicity(papers(spark, sf_dir), "identifier_key")


@query("SELECT count(*) AS total, count(DISTINCT doi) AS unique_dois, count(doi) - count(DISTINCT doi) AS surplus, (SELECT count(*) FROM (SELECT doi FROM papers WHERE doi IS NOT NULL GROUP BY doi HAVING count(*) > 1)) AS repeated FROM papers")
def dup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.duplicates(papers(spark, sf_dir), "doi")


@query(", g AS (SELECT identifier_key, count(*) AS n, count(DISTINCT title) AS t FROM papers GROUP BY 1 HAVING count(*) > 1) SELECT count(*) FILTER (t = 1) AS same_title, count(*) FILTER (t > 1) AS other_title FROM g")
def dup_title_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.title_groups(papers(spark, sf_dir))


@query(", g AS (SELECT doi, count(*) AS row_count, count(DISTINCT source) AS source_count, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(staging_id::VARCHAR, ',' ORDER BY staging_id) AS ids, arg_min(title, staging_id) AS first_title FROM papers WHERE doi IS NOT NULL GROUP BY doi) SELECT * FROM g WHERE row_count > 1")
def doi_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.groups(papers(spark, sf_dir), "doi").where("row_count > 1")


@query("SELECT staging_id, source, identifier_key FROM papers QUALIFY row_number() OVER (PARTITION BY identifier_key ORDER BY staging_id) = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(papers(spark, sf_dir).select("staging_id", "source", "identifier_key"), ["identifier_key"], F.col("staging_id"))


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS k FROM orders) WHERE k IS NULL UNION ALL SELECT o_orderkey, o_custkey FROM (SELECT * FROM (SELECT *, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS k FROM orders) WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1)", staged=False)
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("k"))
    return dedup.keep_last_keyed(orders, "k", "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT staging_id, title FROM papers WHERE trim(coalesce(title, '')) <> '' AND trim(coalesce(abstract, '')) <> '' AND doi IS NOT NULL")
def required_fields_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.pick(filters.required(papers(spark, sf_dir), ["doi", "title", "abstract"]), ["staging_id", "title"])


@query("SELECT 'doi' AS field, count(*) FILTER (coalesce(trim(doi), '') = '') AS missing FROM papers UNION ALL SELECT 'title', count(*) FILTER (coalesce(trim(title), '') = '') FROM papers UNION ALL SELECT 'abstract', count(*) FILTER (coalesce(trim(abstract), '') = '') FROM papers UNION ALL SELECT 'any', count(*) FILTER (coalesce(trim(doi), '') = '' OR coalesce(trim(title), '') = '' OR coalesce(trim(abstract), '') = '') FROM papers")
def missing_field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.missing_report(papers(spark, sf_dir), ["doi", "title", "abstract"])


@query("SELECT staging_id, source FROM papers WHERE contains(lower(coalesce(title, '')), 'the') OR contains(lower(coalesce(abstract, '')), 'the')")
def keyword_title_or_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keyword(papers(spark, sf_dir), "THE", "title", "abstract").select("staging_id", "source")


@query("SELECT p.staging_id, l.quality, l.toxic FROM papers p JOIN labels l ON l.doc_id = p.staging_id WHERE contains(lower(coalesce(p.title, '') ), 'en') OR contains(lower(coalesce(p.abstract, '')), 'en')")
def keyword_join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "staging_id")
    return filters.keyword(joins.with_abstracts(papers(spark, sf_dir), labels, "staging_id"), "en", "title", "abstract").select("staging_id", "quality", "toxic")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)", staged=False)
def keyword_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.among(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where("quality = 1"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)", staged=False)
def unlabelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.absent(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id", "lang")


@query("SELECT count(*) AS ids, count(*) FILTER (l.doc_id IS NOT NULL) AS found, count(*) FILTER (l.quality = 1) AS positive FROM documents d LEFT JOIN labels l USING (doc_id)", staged=False)
def coverage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("hit"))
    return read(spark, sf_dir, "documents").join(labels, "doc_id", "left").agg(F.count("*").alias("ids"), F.count("hit").alias("found"), F.count_if(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("positive"))


@query("SELECT staging_id FROM papers WHERE NOT (regexp_matches(coalesce(title, ''), '(?i)and|der') OR regexp_matches(coalesce(abstract, ''), '(?i)and|der'))")
def exclude_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.without_pattern(papers(spark, sf_dir), "and|der", "title", "abstract").select("staging_id")


@query("SELECT staging_id, source FROM papers WHERE source NOT IN ('src1', 'src3') AND staging_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def exclude_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.excluding_values(papers(spark, sf_dir), "source", ["src1", "src3"])
    return filters.excluding(rows, "staging_id", read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")).select("staging_id", "source")


@query("SELECT staging_id, CASE source WHEN 'src0' THEN 'zero' WHEN 'src7' THEN 'seven' ELSE source END AS source FROM papers")
def override_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.createDataFrame([("src0", "zero"), ("src7", "seven")], "key string, value string")
    return joins.overridden(papers(spark, sf_dir).select("staging_id", "source"), "source", "source", fixed)


@query("SELECT doc_id, text FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1", staged=False)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dml.insert_ignore(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 or doc_id % 4 = 0"), ["doc_id"], F.col("doc_id"))


@query("SELECT o_custkey AS k, max(o_orderkey) AS seq, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1", staged=False)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"))
    early = dedup.keep_first(rows, ["k"], F.col("seq"))
    return dml.upsert(early, rows, ["k"], "seq")


@query("SELECT d.doc_id, CASE WHEN d.doc_id % 3 <> 0 AND trim(text) <> '' THEN text WHEN l.quality IS NOT NULL THEN 'label ' || l.quality WHEN d.lang IS NOT NULL THEN 'lang ' || d.lang END AS abstract, CASE WHEN d.doc_id % 3 <> 0 AND trim(text) <> '' THEN NULL WHEN l.quality IS NOT NULL THEN 'crossref' WHEN d.lang IS NOT NULL THEN 'openalex' END AS abstract_source FROM documents d LEFT JOIN labels l USING (doc_id)", staged=False)
def update_missing_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    have = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    text, source = joins.fallback(have, ("crossref", F.when(F.col("quality").isNotNull(), F.concat(F.lit("label "), F.col("quality").cast("string")))), ("openalex", F.concat(F.lit("lang "), "lang")))
    return rows.select("doc_id", text.alias("abstract"), source.alias("abstract_source"))


@query("SELECT doc_id, source, CASE WHEN quality IS NULL THEN lang ELSE 'labelled' END AS lang FROM documents LEFT JOIN labels USING (doc_id)", staged=False)
def update_from_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), F.lit("labelled").alias("value"))
    return dml.update_from(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), mapping, "doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)", staged=False)
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.delete_keys(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels").where("quality = 0"), ["doc_id"])


@query("SELECT lang, source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) <= 3", staged=False)
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.top_n(read(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars"), ["lang", "source"], 3, F.desc("n_chars"), F.asc("doc_id"))


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20", staged=False)
def top_k_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.top_k(read(spark, sf_dir, "lineitem"), "l_partkey", 20)


@query("SELECT staging_id, identifier_key FROM papers WHERE identifier_key IN (SELECT identifier_key FROM papers GROUP BY 1 HAVING count(*) > 1)")
def duplicated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicated(papers(spark, sf_dir).select("staging_id", "identifier_key"), "identifier_key")


@query("SELECT doc_id, lang, NULL::VARCHAR AS role, 'documents' AS source FROM documents UNION ALL SELECT conv_id, NULL, role, 'conversations' FROM conversations", staged=False)
def stacked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.stacked({"documents": read(spark, sf_dir, "documents").select("doc_id", "lang"), "conversations": read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "role")})


@query("SELECT identifier_value FROM papers WHERE lang = 'en' INTERSECT SELECT identifier_value FROM papers WHERE source_priority < 10")
def shared_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir)
    return setops.common(rows.where("lang = 'en'").select("identifier_value"), rows.where("source_priority < 10").select("identifier_value"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels", staged=False)
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.difference(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 200) AS BIGINT) AS batch FROM documents", staged=False)
def batches_of_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.batched(read(spark, sf_dir, "documents").select("doc_id"), 200, F.col("doc_id"))


@query("SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) AS number FROM documents", staged=False)
def dense_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.numbered(read(spark, sf_dir, "documents").select("doc_id", "lang"), "number", F.col("lang"), F.col("doc_id")).select("doc_id", "number")


@query("SELECT * FROM (SELECT doc_id, source FROM documents WHERE source = 'src2' AND lang IN ('en', 'fr') ORDER BY doc_id LIMIT 25)", staged=False)
def pending_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").where(F.col("lang").isin("en", "fr")).select("doc_id", "source", F.col("source").alias("canonical_source"), F.lit("pending").alias("download_status"), F.format_string("ID%09d", "doc_id").alias("paper_uid"))
    return filters.pending(rows, "src2", 25).select("doc_id", "source")


@query("SELECT * FROM (SELECT doc_id FROM (SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 THEN 1 WHEN doc_id % 5 = 1 THEN NULL ELSE 0 END AS tested FROM documents) WHERE trim(source) <> '' AND coalesce(tested, 0) = 0 ORDER BY doc_id LIMIT 100)", staged=False)
def unprocessed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = F.when(F.col("doc_id") % 5 == 0, 1).when(F.col("doc_id") % 5 != 1, 0)
    return filters.unprocessed(read(spark, sf_dir, "documents").withColumn("tested", tested), "source", "tested", "doc_id", 100).select("doc_id")


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'scopus_error' WHEN quality = 0 THEN 'scopus_search' END AS status FROM labels WHERE NOT coalesce(CASE WHEN toxic = 1 THEN 'scopus_error' WHEN quality = 0 THEN 'scopus_search' END, '') IN ('scopus_search', 'scopus_no_abstract', 'scopus_not_found', 'scopus_error')", staged=False)
def open_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "scopus_error").when(F.col("quality") == 0, "scopus_search").alias("status"))
    return rows.where(filters.lacks_abstract(F.lit(None).cast("string"), F.col("doc_id").cast("string"), F.col("status")))


@query("SELECT round(avg((quality = 1 - toxic)::INT), 6)::DOUBLE AS agreement, round(CASE WHEN pe = 1 THEN 1 ELSE (po - pe) / (1 - pe) END, 6)::DOUBLE AS kappa FROM labels, (SELECT avg((quality = 1 - toxic)::INT)::DOUBLE AS po, avg(quality)::DOUBLE * avg(1 - toxic)::DOUBLE + (1 - avg(quality)::DOUBLE) * (1 - avg(1 - toxic)::DOUBLE) AS pe FROM labels) k GROUP BY po, pe", staged=False)
def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.agreement(read(spark, sf_dir, "labels"), F.col("quality"), 1 - F.col("toxic"))


@query("SELECT quality, count(*) FILTER (toxic = 0) AS toxic_0, count(*) FILTER (toxic = 1) AS toxic_1 FROM labels GROUP BY quality", staged=False)
def label_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.crosstab(read(spark, sf_dir, "labels"), "quality", "toxic", [0, 1])


@query("SELECT source, count(*) AS labelled, round(avg(toxic), 3)::DOUBLE AS fraction, round(100.0 * sum(quality) / count(*), 1)::DOUBLE AS rate FROM documents JOIN labels USING (doc_id) GROUP BY source", staged=False)
def positive_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return rows.groupBy("source").agg(F.count("*").alias("labelled"), F.round(F.avg("toxic"), 3).alias("fraction"), percent(F.sum("quality"), F.count("*"), 1).alias("rate"))


@query("SELECT lang, source, count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents GROUP BY 1, 2", staged=False)
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))


@query("SELECT lang, term, count(*) AS n FROM (SELECT lang, trim(unnest(string_split(split_part(text, chr(10), 1), ','))) AS term FROM documents) WHERE term <> '' GROUP BY 1, 2", staged=False)
def explode_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.terms(read(spark, sf_dir, "documents"), "lang", F.split_part("text", F.lit("\n"), F.lit(1)), ",")


@query("SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality", staged=False)
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left").groupBy("quality").agg(F.count("*").alias("n"))


@query("SELECT source, coalesce(quality::VARCHAR, 'missing') AS status, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2", staged=False)
def status_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.groupBy("source", F.coalesce(F.col("quality").cast("string"), F.lit("missing")).alias("status")).agg(F.count("*").alias("n"))


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)", staged=False)
def benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.containment(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("SELECT source, lang, count(*) AS n, count(*) FILTER (text IS NOT NULL AND trim(text) <> '') AS filled FROM documents GROUP BY 1, 2", staged=False)
def filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(is_filled_sql(F.col("text"))).alias("filled"))
