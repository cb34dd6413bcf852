"""Whether all texts of a group agree, and how well, without pairing the rows of a group in a join.

The reference compares every two texts of a group. That all reach a similarity can mostly be told from one of them: letters deleted and inserted are a metric, so texts
that are near enough to the same text are near each other, and one that is too far from it fails the whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import distance_within, indel
from ..session import cut

#: Texts that every other one is compared with before the pairs that are still open are; texts of a block of pairs.
ROUNDS, BLOCK = 8, 128
#: What sums of distances may be off by as floating-point numbers: pairs this near to the limit are compared.
SLACK = 1e-6


def texts_of(df: DataFrame, group: str, text: str) -> DataFrame:
    """The different texts of each group, null as empty; rows without a group are left out."""
    return df.where(F.col(group).isNotNull()).select(F.col(group).alias("group"), F.coalesce(text, F.lit("")).alias("text")).distinct()


def in_blocks(texts: DataFrame, score, schema: str, block: int = BLOCK) -> DataFrame:
    """`score(group, frame of own, text)` for each two blocks of a group's texts; every pair meets once, where `own` differs or both blocks are one.

    A task holds two blocks, however large the group is.
    """
    sizes = texts.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("text"), F.col("blocks").cast("long")).cast("int")
    dealt = texts.join(sizes, "group").select("group", "text", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return dealt.select("group", "text", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).groupBy("group", "low", "high").applyInPandas(score, schema)


def _pairs(one: bool, frame: pd.DataFrame) -> Iterator[tuple[str, str]]:
    """Pairs within a block, or between two of them, of which one may be empty."""
    parts = [list(x) for _, x in frame.groupby("own")["text"]]
    for i, a in enumerate(parts[0]):
        for b in parts[0][i + 1 :] if one else parts[1] if len(parts) == 2 else ():
            yield a, b


def pair_scores(df: DataFrame, group: str, text: str, least: float = 90.0, block: int = BLOCK) -> DataFrame:
    """group, least, mean, greatest and number of the similarities of its different texts, and whether all reach `least`; 100 where there is one text.

    A mean needs every pair, so the work is quadratic in the texts of a group; but pairs are made and added up inside tasks of two blocks each.
    """
    texts = texts_of(df, group, text)

    def score(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        scores = [indel(a, b) for a, b in _pairs(key[1] == key[2], frame)]
        return pd.DataFrame({"group": [key[0]], "least": [min(scores, default=float("nan"))], "total": [float(sum(scores))], "greatest": [max(scores, default=float("nan"))], "pairs": [len(scores)]})

    kind = texts.schema["group"].dataType.simpleString()
    parts = in_blocks(texts, score, f"group {kind}, least double, total double, greatest double, pairs long", block)
    sums = parts.groupBy("group").agg(F.min(F.nanvl("least", F.lit(None))).alias("least"), F.sum("total").alias("total"), F.max(F.nanvl("greatest", F.lit(None))).alias("greatest"), F.sum("pairs").alias("pairs"))
    alone = F.lit(100.0)
    return sums.select(F.col("group").alias(group), F.coalesce("least", alone).alias("least"), F.coalesce(F.try_divide("total", "pairs"), alone).alias("mean"), F.coalesce("greatest", alone).alias("greatest"), "pairs", (F.coalesce("least", alone) >= least).alias("passed"))


def all_agree(df: DataFrame, group: str, text: str, least: float = 90.0, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """group, kinds (different texts) and passed: whether every two of them reach `least`, as comparing all pairs would say.

    The shortest and the longest text decide many groups by their lengths. Then one text of each group is compared with all others: one that falls short
    fails the group, and a text is settled if its distance and the greatest of the group together stay within what the two may differ by. Of the rest the farthest
    is the next to be compared, which settles it at least. What is open after `rounds` is compared in blocks. A round costs as many comparisons as there are open texts.
    """
    lose = 1 - least / 100

    @F.pandas_udf("long")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([distance_within(x, y, least) for x, y in zip(a, b, strict=True)], dtype="Int64")

    texts = cut(texts_of(df, group, text))
    n = F.length("text")
    sizes = cut(texts.groupBy("group").agg(F.count("*").alias("kinds"), F.min(n).alias("low"), F.max(n).alias("high"), F.min_by("text", F.struct(n, "text")).alias("pivot")))
    by_length = F.when(F.col("low") < F.col("high"), (F.col("low") * 200.0 >= (F.col("low") + F.col("high")) * least)).otherwise(True)
    todo = sizes.where((F.col("kinds") > 1) & by_length)
    rest = texts.join(todo.select("group", "pivot"), "group")
    failed = sizes.where(~by_length).select("group")
    for _ in range(rounds):
        far = F.col("distance") - lose * n
        seen = cut(rest.withColumn("distance", distance("text", "pivot")).select("group", "text", (F.col("text") == F.col("pivot")).alias("done"), F.col("distance").isNull().alias("apart"), far.alias("far")))
        stats = seen.groupBy("group").agg(F.bool_or("apart").alias("apart"), F.max(F.when(~F.col("done"), F.col("far"))).alias("most"), F.max_by("text", F.when(~F.col("done"), F.struct("far", "text"))).alias("pivot"))
        failed = failed.union(stats.where("apart").select("group"))
        rest = cut(seen.join(stats.where("not apart"), "group").where(~F.col("done") & (F.col("far") + F.col("most") > -SLACK)).select("group", "text", "pivot"))
        if rest.isEmpty():
            break
    else:

        def apart(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"group": [key[0]], "apart": [any(distance_within(a, b, least) is None for a, b in _pairs(key[1] == key[2], frame))]})

        kind = texts.schema["group"].dataType.simpleString()
        failed = failed.union(in_blocks(rest.select("group", "text"), apart, f"group {kind}, apart boolean", block).where("apart").select("group"))
    bad = failed.distinct().withColumn("bad", F.lit(True))
    return sizes.join(bad, "group", "left").select(F.col("group").alias(group), "kinds", F.col("bad").isNull().alias("passed"))
