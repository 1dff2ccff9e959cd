"""Population ranks: mid-rank percentile, normal score, standard score, rating, depth order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions.scalars import probit
from tallywright.operators.ordered import ROWS_PER_TASK, ordered_scan, plan_cuts

# Fixed value: ratings run from 0 to 99.
RATING_SCALE = 99.0


def undefined_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows a rank would have to refuse (C16); empty when every value is defined."""
    return df.where(F.col(value).isNull() | F.isnan(F.col(value).cast("double"))).select(*keys)


def mid_rank(df: DataFrame, by: list[str], value: str, out: str = "percentile",
             limit: int = ROWS_PER_TASK) -> DataFrame:
    """(#lower + #tied / 2) / N inside each ``by`` group, ties including the row itself.

    Values are counted first (map-side), so a group or a single value holding most rows never meets
    in one task; the running count then runs over distinct values, in chunks where a group is hot.
    """
    known = df.where(F.col(value).isNotNull())
    tied = known.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__tied"))
    cuts = plan_cuts(tied, by, value, limit)
    lower = ordered_scan(tied, by, [value], {"__lower": ("sum_before", "__tied")}, cuts)
    totals = tied.groupBy(*by).agg(F.sum("__tied").alias("__n"))
    ranks = lower.join(totals, by).select(
        *by, value, ((F.col("__lower") + 0.5 * F.col("__tied")) / F.col("__n")).alias(out))
    return df.join(ranks, [*by, value], "left")


def normal_score(df: DataFrame, by: list[str], value: str, out: str = "z") -> DataFrame:
    ranked = mid_rank(df, by, value, "__pct")
    return ranked.withColumn(out, probit("__pct")).drop("__pct")


def standard_score(df: DataFrame, by: list[str], value: str, out: str = "z") -> DataFrame:
    """(x - mean) / population SD; a group without spread scores 0."""
    v = F.col(value)
    moments = df.groupBy(*by).agg(F.avg(v).alias("__mean"), F.stddev_pop(v).alias("__sd"))
    # Fixed value: spread below this share of the mean counts as none.
    flat = F.col("__sd") <= 1e-12 * F.greatest(F.lit(1.0), F.abs("__mean"))
    score = F.when(v.isNull(), None).when(flat, 0.0).otherwise((v - F.col("__mean")) / F.col("__sd"))
    return df.join(moments, by).withColumn(out, score).drop("__mean", "__sd")


def rate_scores(df: DataFrame, by: list[str], score: str) -> DataFrame:
    """Add ``percentile`` and the unrounded 0-99 ``rating``.

    Ranked on the score without its last rounding noise, so scores that differ only by the order
    their parts were added in tie; the score itself stays as it is.
    """
    keyed = df.withColumn("__key", F.round(score, 12))
    return mid_rank(keyed, by, "__key", "percentile").drop("__key").withColumn(
        "rating", RATING_SCALE * F.col("percentile"))


def depth_rank(df: DataFrame, group: str, entity: str, starts: str, average: str,
               out: str = "depth_rank", limit: int = ROWS_PER_TASK) -> DataFrame:
    """Top five of a group by starts, everyone after them by average.

    ``row_number() <= 5`` is limited before its shuffle; the rest is a running count, in chunks
    where a group is hot.
    """
    keyed = df.withColumn("__a", -F.col(average).cast("double")).withColumn(
        "__s", -F.col(starts).cast("double"))
    by_starts = W.partitionBy(group).orderBy("__s", "__a", entity)
    lead = keyed.withColumn(out, F.row_number().over(by_starts)).where(F.col(out) <= 5)
    rest = keyed.join(lead.select(group, entity), [group, entity], "left_anti")
    cuts = plan_cuts(rest, [group], "__a", limit)
    later = ordered_scan(rest, [group], ["__a", "__s", entity], {out: ("sum", F.lit(1))}, cuts)
    later = later.withColumn(out, (F.col(out) + 5).cast("int"))
    return lead.unionByName(later).drop("__a", "__s")
