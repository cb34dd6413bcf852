"""URL filters: rules by host and path, and trust and distrust that links carry to the hosts that no rule settles.

Hosts are seeds as far as rules settle their pages: by the share of pages that are allowed or blocked. Personalised PageRank carries trust along links, from allowed hosts
to those that they link to; distrust goes the other way, from blocked hosts to those that link to them. Beside each runs the same walk from all hosts alike, so
that the quotient tells, whatever the size of the graph, which part of a host's rank stems from trusted (or distrusted) seeds.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut


@dataclass(frozen=True)
class Rule:
    """Pages of a host and its subdomains whose path begins with `path`."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Part of a walk that goes on along a link; steps; a checkpoint after so many of them. What later steps would add is below DAMPING ** ROUNDS of a host's rank.
DAMPING, ROUNDS, EVERY = 0.85, 30, 5
#: A host is blocked if the distrusted part of its rank exceeds the trusted part by more.
MARGIN = 0.5
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hosts of absolute links in attributes, with or without a scheme.
LINK = r"(?i)\b(?:href|src|action)\s*=\s*(?:[\"']\s*)?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s\"'<>]+)"
SCORES = ("trust", "rank", "distrust", "back")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without it."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits (of equally long ones the first by text), or nulls. The rules are a list that the caller has written."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        text, action = F.when(fits, r.text).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def host_links(pages: DataFrame) -> DataFrame:
    """a, b, n: on n pages of host a there is a link to the other host b. Pages without a host have none."""
    to = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1)))
    return pages.where("host <> ''").select(F.col("host").alias("a"), to.alias("b")).select("a", lower_ascii(F.col("b")).alias("b")).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))


def seeds(judged: DataFrame) -> DataFrame:
    """host, and the shares of its pages that rules allow and block."""
    action = F.col("action")
    return judged.where("host <> ''").groupBy("host").agg(F.avg(F.coalesce((action == "allow").cast("double"), F.lit(0.0))).alias("allowed"), F.avg(F.coalesce((action == "block").cast("double"), F.lit(0.0))).alias("blocked"))


def propagate(hosts: DataFrame, links: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS, every: int = EVERY) -> DataFrame:
    """host with `trust` and `distrust`: the parts of its rank that stem from hosts(host, allowed, blocked) by links(a, b, n) between these.

    Links of other hosts are left out. One join and one sum a step serve all four walks; partial sums meet hosts with very many links, and the lineage is
    cut every few steps. Only hosts move, never pages, and none of them goes to the driver.
    """
    names = hosts.select("host")
    links = links.join(names.withColumnRenamed("host", "a"), "a", "left_semi").join(names.withColumnRenamed("host", "b"), "b", "left_semi")
    ahead = links.join(links.groupBy("a").agg(F.sum("n").alias("all")), "a").select(F.col("a").alias("from"), F.col("b").alias("to"), (F.col("n") / F.col("all")).alias("along"), F.lit(0.0).alias("against"))
    behind = links.join(links.groupBy("b").agg(F.sum("n").alias("all")), "b").select(F.col("b").alias("from"), F.col("a").alias("to"), F.lit(0.0).alias("along"), (F.col("n") / F.col("all")).alias("against"))
    flows = cut(ahead.unionByName(behind))
    base = cut(hosts.select("host", F.col("allowed").alias("trust"), F.lit(1.0).alias("rank"), F.col("blocked").alias("distrust"), F.lit(1.0).alias("back")))
    now = base
    way = {"trust": "along", "rank": "along", "distrust": "against", "back": "against"}
    for step in range(1, 0 if flows.isEmpty() else rounds + 1):
        moved = flows.join(now, F.col("from") == F.col("host")).select(F.col("to").alias("host"), *((F.col(s) * F.col(way[s]) * damping).alias(s) for s in SCORES))
        own = base.select("host", *((F.col(s) * (1 - damping)).alias(s) for s in SCORES))
        now = moved.unionByName(own).groupBy("host").agg(*(F.sum(s).alias(s) for s in SCORES))
        now = cut(now) if step % every == 0 else now
    return now.select("host", F.round(F.col("trust") / F.col("rank"), 9).alias("trust"), F.round(F.col("distrust") / F.col("back"), 9).alias("distrust"))


def url_filter(pages: DataFrame, *, rules: Sequence[Rule] = RULES, margin: float = MARGIN, **walk) -> DataFrame:
    """Each page with host, path, the rule that fits it and a verdict: the rule's, or by trust and distrust of its host, which are returned too.

    Null urls and those without `://` have an empty host, fit no rule and are allowed. A null html has no links. A page_id may be null or repeated; every row is
    judged by itself and counts as a page of its host. No rows give no rows. Only page_id, url and html are read, so other columns may have any name.
    """
    url = pages.select("page_id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, action = ruled(F.col("host"), F.col("path"), rules)
    judged = url.select("page_id", "host", "path", rule.alias("rule"), action.alias("action"))
    found = propagate(cut(seeds(judged)), host_links(url), **walk)
    scored = judged.join(found, "host", "left")
    distrusted = F.col("distrust") - F.col("trust") > margin
    verdict = F.coalesce("action", F.when(distrusted, "block"), F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def _sql() -> str:
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN" for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))]
    text, action = (" ".join(f"{f} '{x}'" for f, x in zip(fits, values, strict=True)) for values in ([r.text for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))], [r.action for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))]))
    lower = lambda x: f"translate({x}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    link = LINK.replace("'", "''")
    d = DAMPING
    return f"""WITH RECURSIVE urls AS (SELECT page_id, html, {lower(f"coalesce(regexp_extract(url, '{URL}', 1), '')")} AS host, coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
judged AS (SELECT page_id, host, path, CASE {text} END AS rule, CASE {action} END AS action FROM urls),
hosts AS (SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) AS blocked FROM judged WHERE host <> '' GROUP BY 1),
found AS (SELECT host AS a, {lower("x")} AS b FROM (SELECT host, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS x FROM urls WHERE host <> '')),
links AS (SELECT a, b, count(*) AS n FROM found WHERE a <> b AND b IN (SELECT host FROM hosts) GROUP BY 1, 2),
flows AS (SELECT a AS f, b AS t, n / sum(n) OVER (PARTITION BY a) AS along, 0.0 AS against FROM links UNION ALL SELECT b, a, 0.0, n / sum(n) OVER (PARTITION BY b) FROM links),
walks(step, host, trust, rank, distrust, back) AS (SELECT 0, host, CAST(allowed AS DOUBLE), CAST(1 AS DOUBLE), CAST(blocked AS DOUBLE), CAST(1 AS DOUBLE) FROM hosts
  UNION ALL SELECT step + 1, host, sum(trust), sum(rank), sum(distrust), sum(back) FROM (
    SELECT w.step, h.host, {1 - d} * h.allowed AS trust, {1 - d} AS rank, {1 - d} * h.blocked AS distrust, {1 - d} AS back FROM hosts h JOIN walks w USING (host)
    UNION ALL SELECT w.step, f.t, {d} * f.along * w.trust, {d} * f.along * w.rank, {d} * f.against * w.distrust, {d} * f.against * w.back FROM flows f JOIN walks w ON w.host = f.f) WHERE step < {ROUNDS} GROUP BY step, host),
scores AS (SELECT host, round(distrust / back, 9) - round(trust / rank, 9) AS bad FROM walks WHERE step = {ROUNDS})
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN bad > {MARGIN} THEN 'block' END, 'allow') AS verdict FROM judged LEFT JOIN scores USING (host)"""


ORACLE = _sql()


def op13_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
