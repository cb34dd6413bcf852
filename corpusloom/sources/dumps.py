"""Readers of landed dumps and captured pages, and writers for export. Fetching them is not the engine's work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.markup import atom_feed
from ..functions.text import null_if_blank, scopus_affiliation
from ..functions.convert import whole_number, yes_flag

ABSTRACTS = "corpusid long, abstract string"
PAPERS = "corpusid long, externalids map<string,string>, url string, title string, authors array<struct<authorId:string,name:string>>, venue string, publicationvenueid string, year int, referencecount int, citationcount int, influentialcitationcount int, isopenaccess boolean, s2fieldsofstudy array<struct<category:string,source:string>>, publicationtypes array<string>, publicationdate string, journal struct<name:string,pages:string,volume:string>"
AUTHORS = "authorid long, externalids map<string,array<string>>, url string, name string, aliases array<string>, affiliations array<string>, homepage string, papercount int, citationcount int, hindex int"
S2ORC = "corpusid long, title string, authors array<struct<authorId:string,name:string>>, openaccessinfo struct<externalids:map<string,string>,license:string,url:string,status:string>, body struct<text:string,annotations:string>, bibliography struct<text:string,annotations:string>"
BAD = "_bad"


def jsonl(spark: SparkSession, path: str | list[str], schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Records of (gzip) JSON lines. PERMISSIVE keeps malformed lines in `_bad`, DROPMALFORMED drops them, FAILFAST fails; the
    last two judge the fields that are read. A gzip file is one task, so rows are dealt out before anything heavy."""
    kept = f"{schema}, {BAD} string" if mode == "PERMISSIVE" else schema
    return spark.read.schema(kept).option("mode", mode).option("columnNameOfCorruptRecord", BAD).json(path)


def keyed_records(df: DataFrame, key: str, text: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good records, and counts (rows, bad, empty): bad are malformed or without key, empty lack `text` ('' counts, white space doesn't)."""
    bad = F.col(key).isNull() | (F.col(BAD).isNotNull() if BAD in df.columns else F.lit(False))
    empty = ~bad & (F.coalesce(F.col(text), F.lit("")) == "") if text else F.lit(False)
    counts = df.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad"), F.count_if(empty).alias("empty"))
    return df.where(~bad & ~empty).drop(BAD), counts


def as_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text and booleans as 0/1, as the row store keeps them."""
    out = {}
    for f in df.schema:
        kind = f.dataType.typeName()
        out[f.name] = F.to_json(f.name) if kind in ("struct", "array", "map") else F.col(f.name).cast("int") if kind == "boolean" else F.col(f.name)
    return df.select(*(c.alias(n) for n, c in out.items()))


def export_jsonl(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists") -> None:
    (df.coalesce(1) if single else df).write.mode(mode).option("compression", "gzip").json(path)


def tsv(spark: SparkSession, *paths: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(list(paths))


def markdown_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder, path, text) of folders that hold exactly one Markdown file."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    named = files.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    alone = named.groupBy("folder").agg(F.count("*").alias("n")).where("n = 1").select("folder")
    return named.join(alone, "folder", "left_semi").select("folder", "path", "text")


def binary_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)


SCOPUS = "`search-results` struct<`opensearch:totalResults`:string,cursor:struct<`@next`:string>,entry:array<struct<eid:string,`prism:doi`:string,`dc:title`:string,`dc:creator`:string,`prism:publicationName`:string,`dc:publisher`:string,openaccess:string,openaccessFlag:boolean,affiliation:array<struct<affilname:string,`affiliation-city`:string,`affiliation-country`:string>>>>>"


def scopus_papers(spark: SparkSession, path: str) -> DataFrame:
    """Papers of captured search pages."""
    e = spark.read.schema(SCOPUS).option("multiLine", True).json(path).select(F.explode("search-results.entry").alias("e"))
    places = F.transform("e.affiliation", lambda a: F.struct(a["affilname"].alias("affilname"), a["affiliation-city"].alias("city"), a["affiliation-country"].alias("country")))
    return e.select("e.eid", F.col("e.`prism:doi`").alias("doi"), F.col("e.`dc:title`").alias("title"), F.col("e.`dc:creator`").alias("author"), F.col("e.`prism:publicationName`").alias("journal"), F.col("e.`dc:publisher`").alias("publisher"), F.col("e.openaccess").alias("open_access"), F.col("e.openaccessFlag").cast("int").alias("open_access_flag"), scopus_affiliation(places).alias("affiliation")).where("eid is not null")


EUROPEPMC = "hitCount long, nextCursorMark string, resultList struct<result:array<struct<doi:string,pmcid:string,pmid:string,title:string,abstractText:string,authorString:string,affiliation:string,journalInfo:struct<journal:struct<title:string>>,pubYear:string,isOpenAccess:string,inEPMC:string,inPMC:string,hasPDF:string>>>"


def europepmc_papers(spark: SparkSession, path: str) -> DataFrame:
    r = spark.read.schema(EUROPEPMC).option("multiLine", True).json(path).select(F.explode("resultList.result").alias("r")).select("r.*")
    flags = {"is_open_access": "isOpenAccess", "in_epmc": "inEPMC", "in_pmc": "inPMC", "has_pdf": "hasPDF"}
    return r.select("doi", "pmcid", "pmid", "title", F.col("abstractText").alias("abstract"), F.col("authorString").alias("authors"), "affiliation", F.col("journalInfo.journal.title").alias("journal"), whole_number(F.col("pubYear")).cast("int").alias("publication_year"), *(yes_flag(F.col(c)).alias(n) for n, c in flags.items())).where("pmcid is not null")


def arxiv_papers(spark: SparkSession, path: str) -> DataFrame:
    feed = spark.read.option("wholetext", True).text(path).select(atom_feed("value").alias("f"))
    return feed.select(F.explode("f.entries").alias("e")).select("e.*").where(null_if_blank(F.col("arxiv_id")).isNotNull())


def manifest(files: DataFrame, fixed: list[str], pattern: str, landed: DataFrame) -> DataFrame:
    """Files(name, url) of a manifest to fetch: the fixed ones, which must be there, and those that match the pattern; landed ones are left out."""
    have = {r["name"] for r in files.where(F.col("name").isin(fixed)).select("name").collect()}
    if lost := sorted(set(fixed) - have):
        raise ValueError(f"the manifest lacks {lost}")
    return files.where(F.col("name").isin(fixed) | F.col("name").rlike(f"^(?:{pattern})$")).join(landed.select("name"), "name", "left_anti")
