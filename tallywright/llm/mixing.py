"""Mixing sources to target weights by nested hash thresholds, without a sort of the documents.

Each document has a fixed 60-bit place on a line, the leading digits of an md5 of its id, its text and, among rows equal in both, a running
number; such rows are set apart and numbered per input partition, with what the partitions before hold added. Per source, word counts are summed in
1,024 buckets of that line; running sums of the buckets show in which one a budget ends. Only documents of that boundary bucket are
summed again, by the next ten bits, and so on through all six levels; the place reached is the threshold, and a filter on it is
the whole selection. Thresholds of growing budgets are nested: a document taken for a small budget is taken for every larger one.

Defined cases: null or wordless texts have size 0 and are taken 0 words; documents without a source form the last source; rows
without an id or with one id have places of their own, also where their texts are equal; a source of size 0 has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.llm.common import cut, query, read, words_of

LEVEL_BITS, LEVELS = 10, 6
PLACE_BITS = LEVEL_BITS * LEVELS


def mark(doc_id: Column, text: Column) -> Column:
    """A text form of id and text; null counts as empty."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def place(of: Column, nth: Column) -> Column:
    """The first 15 hex digits of md5 of a mark and a number, as a long."""
    digits = F.substring(F.md5(F.concat_ws(":", of, nth.cast("string")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def placed(docs: DataFrame, *columns: Column) -> DataFrame:
    """The given columns of docs (doc_id, text, ...) and `place`. Equal rows differ in their number, so it does not matter which has which."""
    rows = docs.select(*columns, mark(F.col("doc_id"), F.col("text")).alias("__mark"))
    repeated = cut(rows.groupBy("__mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__mark"))
    lone = rows.join(repeated, "__mark", "left_anti").withColumn("__nth", F.lit(0).cast("long"))
    many = cut(rows.join(repeated, "__mark", "left_semi").withColumn("__part", F.spark_partition_id()))
    held = many.groupBy("__mark", "__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("__mark").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    held = held.select(F.col("__mark").alias("m"), F.col("__part").alias("p"), before.alias("before"))
    nth = F.row_number().over(W.partitionBy("__mark", "__part").orderBy("__part")) - 1
    many = many.withColumn("__row", nth).join(held, (F.col("__mark") == F.col("m")) & (F.col("__part") == F.col("p")))
    many = many.withColumn("__nth", (F.col("__row") + F.col("before")).cast("long")).drop("__part", "__row", "m", "p", "before")
    rows = lone.unionByName(many)
    return rows.withColumn("place", place(F.col("__mark"), F.col("__nth"))).drop("__mark", "__nth")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Per source: size, weight and target. sizes: (source, source_size).

    Weights repeat over the sources by code point, null last. All sizes together are shared by weight; a share stops at
    `max_repeats` times the source's size and the excess is shared again. The end state is a water level: with sources by
    size over weight, those below the level are full, and the level follows from what is left for the rest.
    """
    by_name, by_need, after = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("need", "nth"), W.rowsBetween(1, W.unboundedFollowing)
    whole = W.partitionBy()
    t = (sizes.withColumn("nth", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("nth") % len(weights)).cast("int") + 1).cast("long"))
         .withColumn("full", max_repeats * F.col("source_size"))
         .withColumn("need", F.col("full").cast("double") / F.col("weight")))
    t = (t.withColumn("budget", F.sum("source_size").over(whole))
         .withColumn("full_before", F.coalesce(F.sum("full").over(by_need.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("weight_left", F.sum("weight").over(by_need.rowsBetween(0, W.unboundedFollowing))))
    t = t.withColumn("level", (F.col("budget") - F.col("full_before")).cast("double") / F.col("weight_left"))
    t = t.withColumn("filled", F.col("need") <= F.col("level"))
    rest = F.min(F.when(~F.col("filled"), F.struct("need", "nth", "level"))).over(whole)
    return (t.withColumn("water", rest["level"])
            .withColumn("target", F.when(F.col("filled"), F.col("full").cast("double")).otherwise(F.col("water") * F.col("weight")))
            .select("source", "source_size", "weight", "target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where each budget ends on its source's line: adds `threshold` (documents at lower places are taken).

    sized: (source, size, place), budgets: (source, budget). The document on which a budget ends is taken when the sum is
    nearer to the budget with it than without it.
    """
    found = budgets.select("source", F.col("budget"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("passed"))
    first = None
    for level in range(LEVELS):
        shift = PLACE_BITS - LEVEL_BITS * (level + 1)
        key = F.shiftright(F.col("place"), shift)
        rows = sized.select(F.col("source").alias("s"), F.col("size"), key.alias("bucket"))
        if level:
            edge = found.select(F.col("source").alias("e"), F.col("prefix").alias("p"))
            rows = rows.join(edge, F.col("s").eqNullSafe(F.col("e")) & (F.shiftright("bucket", LEVEL_BITS) == F.col("p")), "left_semi")
        sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
        sums = sums.withColumn("parent", F.shiftright("bucket", LEVEL_BITS))  # the boundary bucket that they refine
        run = W.partitionBy("s", "parent").orderBy("bucket")
        sums = sums.withColumn("after", F.sum("words").over(run))
        here = found.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("prefix") == F.col("parent")))
        before = F.col("passed") + F.col("after") - F.col("words")
        upto = F.col("passed") + F.col("after")
        # the first bucket whose end is not wholly below the budget holds the boundary
        crossed = upto > F.col("budget") if level < LEVELS - 1 else (before + upto) / 2 > F.col("budget")
        first = (here.where(crossed).groupBy("source", "budget")
                 .agg(F.min(F.struct(F.col("bucket"), before.alias("below"))).alias("at")))
        first = first.select(F.col("source").alias("f"), F.col("budget").alias("fb"), F.col("at.bucket").alias("bucket"), F.col("at.below").cast("long").alias("below"))
        if level < LEVELS - 1:
            found = cut(first.select(F.col("f").alias("source"), F.col("fb").alias("budget"), F.col("bucket").alias("prefix"), F.col("below").alias("passed")))
    # nothing crosses on the last level: all of the boundary bucket above it is taken
    done = cut(found.join(first, F.col("source").eqNullSafe(F.col("f")) & (F.col("budget") == F.col("fb")), "left")
               .select("source", "budget", F.coalesce(F.col("bucket"), F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)).alias("threshold")))
    done = done.select(F.col("source").alias("d"), F.col("budget").alias("db"), "threshold")
    # no boundary: the budget covers the whole source
    return (budgets.join(done, F.col("source").eqNullSafe(F.col("d")) & (F.col("budget") == F.col("db")), "left")
            .select("source", "budget", F.coalesce(F.col("threshold"), F.lit(1 << PLACE_BITS)).alias("threshold")))


def mix_plan(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Per source: source_size, target, whole (repeats that all its documents get), threshold (documents below get one more).

    sized: source, size, place; read several times, so best a written table.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, max_repeats)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("int"))
    plan = cut(plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    ends = thresholds(sized, plan.select("source", "budget"))
    plan = plan.join(ends.select(F.col("source").alias("s"), "threshold"), F.col("source").eqNullSafe(F.col("s")), "left")
    return cut(plan.select("source", "source_size", "target", "whole", F.when(F.col("whole") < max_repeats, F.col("threshold")).otherwise(0).alias("threshold")))


def sized_rows(docs: DataFrame) -> DataFrame:
    return cut(placed(docs, F.col("doc_id"), F.col("source"), words_of(F.col("text")).alias("size")))


def with_repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """row, repeats, source_size, target of rows (row, source, place); the plan has one row per source."""
    rows = rows.select("row", F.col("source").alias("__source"), F.col("place").alias("__place"))
    rows = rows.join(plan, F.col("__source").eqNullSafe(F.col("source")))
    return rows.select("row", (F.col("whole") + (F.col("__place") < F.col("threshold")).cast("int")).alias("repeats"), "source_size", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """How often each document goes into the mix: doc_id, source, size, source_size, target, repeats. docs: doc_id, source, text.

    Every whole repeat of a source is taken for all of its documents; the rest of the target is a threshold on the line of places.
    """
    sized = sized_rows(docs)
    rows = with_repeats(sized.select(F.struct("*").alias("row"), "source", "place"), mix_plan(sized, weights, max_repeats))
    return rows.select("row.doc_id", "row.source", "row.size", "source_size", "target", "repeats")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns it came with."""
    plan = mix_plan(sized_rows(docs), weights, max_repeats)
    rows = with_repeats(placed(docs, F.struct("*").alias("row"), F.col("source")), plan).where(F.col("repeats") > 0)
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' ||
           (row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1)), 1, 15))::BIGINT AS place
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source),
need AS (SELECT *, 1 + nth % 3 AS weight, 3 * source_size AS full_size, (3 * source_size)::DOUBLE / (1 + nth % 3) AS need FROM sizes),
run AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS budget,
         coalesce(sum(full_size) OVER (ORDER BY need, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_before,
         sum(weight) OVER (ORDER BY need, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weight_left
  FROM need),
level AS (SELECT *, (budget - full_before)::DOUBLE / weight_left AS level FROM run),
water AS (SELECT arg_min(level, need * 1e6 + nth) AS water FROM level WHERE need > level),
target AS (
  SELECT source, source_size, CASE WHEN need <= level THEN full_size::DOUBLE ELSE water * weight END AS target
  FROM level LEFT JOIN water ON true),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::INT ELSE 0 END AS whole FROM target),
lines AS (
  SELECT s.source, s.place, sum(sum(s.size)) OVER (PARTITION BY s.source ORDER BY s.place) AS upto, sum(s.size) AS words
  FROM sized s GROUP BY s.source, s.place)
SELECT s.doc_id, s.size, w.source_size, w.target,
       (s.size * (w.whole + CASE WHEN w.whole < 3 AND l.upto - l.words / 2.0 <= w.target - w.whole * w.source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source
JOIN lines l ON l.source IS NOT DISTINCT FROM s.source AND l.place = s.place
"""


@query("op4_source_mix", ORACLE)
def source_mix(spark, sf_dir):
    rows = mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).cast("long").alias("taken"))
