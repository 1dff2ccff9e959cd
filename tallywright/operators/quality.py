"""Checks. Row rules return the offending rows (empty = passed); report rules return one row per
check. Nothing is clipped or repaired here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import PAINT_ZONES, safe_div, shot_bucket
from tallywright.operators.ordered import ROWS_PER_TASK, ordered_scan, plan_cuts

# Bounds of the gates.
MATCH_RATE_FLOOR = 0.99
TOTALS_TOLERANCE = 0.01
UNRESOLVED_CEILING = 0.01
CORRELATION_FLAG = 0.9


def split_population(df: DataFrame, off: str, de: str) -> DataFrame:
    """Mark each entity ``exposed``, ``one_sided`` or ``none`` from its two exposures."""
    o, d = F.coalesce(F.col(off), F.lit(0.0)) > 0, F.coalesce(F.col(de), F.lit(0.0)) > 0
    return df.withColumn("population", F.when(o & d, "exposed").when(o | d, "one_sided").otherwise("none"))


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a total order.

    A map-side minimum picks it, so a key with very many copies costs one row per task. The order's columns lead the row that
    is compared, so a column moves once; rows with a map cannot be compared whole.
    """
    rest = [c for c in df.columns if c not in key]
    if any("map<" in kind or "variant" in kind for _name, kind in df.dtypes):
        first = F.min_by(F.struct(*rest), F.struct(*[F.col(o) for o in order]))
    else:
        first = F.min(F.struct(*dict.fromkeys([*order, *rest])))
    picked = df.groupBy(*key).agg(first.alias("__r"))
    return picked.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unknown_labels(df: DataFrame, label: str, allowed: list[str]) -> DataFrame:
    return df.where(F.col(label).isNull() | ~F.col(label).isin(*allowed))


def unclassified_shots(df: DataFrame, action: str, zone: str) -> DataFrame:
    """Paint shots no family claims and that are no jump shots, counted by type."""
    left = df.where(shot_bucket(action, zone).isNull() & F.col(zone).isin(*PAINT_ZONES)
                    & ~F.lower(F.col(action)).contains("jump shot"))
    return left.groupBy(F.col(action).alias("action_type")).agg(F.count(F.lit(1)).alias("n"))


def game_pairs(rows: DataFrame, homes: DataFrame, game: str, team: str) -> DataFrame:
    """Games that do not have exactly two team rows equal to the stated home and away teams."""
    seen = rows.groupBy(game).agg(F.count(F.lit(1)).alias("n_rows"), F.min(team).alias("low"),
                                  F.max(team).alias("high"))
    joined = seen.join(homes, game, "left")
    reason = (F.when((F.col("n_rows") != 2) | (F.col("low") == F.col("high")), "not two team rows")
              .when(F.col("home").isNull() | F.col("away").isNull(), "no box score")
              .when((F.least("home", "away") != F.col("low"))
                    | (F.greatest("home", "away") != F.col("high")), "teams differ"))
    return joined.select(game, "n_rows", reason.alias("problem")).where(F.col("problem").isNotNull())


def contest_checks(contests: DataFrame, league_attempts: float) -> DataFrame:
    """Three consistency checks on long contest counts ``(entity_id, category, A)`` where the
    categories are Overall, P3, P2ALL (all twos) and R."""
    def part(c):
        return F.sum(F.when(F.col("category") == c, F.col("A")).otherwise(0.0))
    per = contests.groupBy("entity_id").agg(part("Overall").alias("o"), part("P3").alias("p3"),
                                            part("P2ALL").alias("p2"), part("R").alias("r"))
    t = per.agg(F.sum("o").alias("o"), F.sum("p3").alias("p3"), F.sum("p2").alias("p2"),
                F.count(F.when(F.col("p2") + 1e-9 < F.col("r"), 1)).alias("bad"))
    league = F.lit(float(league_attempts))
    checks = F.array(
        F.struct(F.lit("threes plus twos within 1% of overall").alias("name"),
                 (F.abs(F.col("p3") + F.col("p2") - F.col("o")) <= TOTALS_TOLERANCE * F.col("o")).alias("ok"),
                 (F.col("p3") + F.col("p2")).alias("detail")),
        F.struct(F.lit("twos at least rim attempts for every entity").alias("name"),
                 (F.col("bad") == 0).alias("ok"), F.col("bad").cast("double").alias("detail")),
        F.struct(F.lit("overall within 1% of league attempts").alias("name"),
                 (F.abs(F.col("o") - league) <= TOTALS_TOLERANCE * league).alias("ok"),
                 F.col("o").alias("detail")))
    return t.select(F.explode(checks).alias("c")).select(
        F.col("c.name").alias("name"), F.col("c.ok").cast("int").alias("ok"),
        F.col("c.detail").alias("detail"))


def match_rate(left: DataFrame, right: DataFrame, key: list[str], floor: float = MATCH_RATE_FLOOR) -> DataFrame:
    """Share of left rows with a partner; right keys are made unique first."""
    marked = left.select(*key).join(right.select(*key).distinct().withColumn("__hit", F.lit(1)), key, "left")
    rate = F.avg(F.coalesce(F.col("__hit"), F.lit(0)))
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), F.count("__hit").alias("n_matched"),
                      F.coalesce(rate, F.lit(1.0)).alias("rate")).withColumn(
        "ok", (F.col("rate") >= floor).cast("int"))


def minutes_agreement(games: DataFrame, rebuilt: str, official: str) -> DataFrame:
    gap = F.abs(F.coalesce(F.col(rebuilt), F.lit(0.0)) - F.col(official))
    return games.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(gap).alias("mean_abs_error"),
                     F.count(F.when(gap > 1.0, 1)).alias("n_over_one"))


def unresolved_share(totals: DataFrame, total: str, unresolved: str) -> DataFrame:
    share = F.coalesce(safe_div(F.sum(unresolved), F.sum(total)), F.lit(0.0))
    return totals.agg(F.sum(total).alias("n_events"), F.sum(unresolved).alias("n_unresolved"),
                      share.alias("share")).withColumn("ok", (F.col("share") <= UNRESOLVED_CEILING).cast("int"))


def completeness(entities: DataFrame, facts: DataFrame, fields: DataFrame, entity: str,
                 status: DataFrame | None = None) -> DataFrame:
    """Per expected field: entities with a value, all entities, and whether that is complete.

    ``facts``: entity, kind, name, present (0/1). ``fields``: kind, name. Counting facts first keeps
    this linear: the entity x field grid is never built.
    """
    have = facts.join(entities.select(entity), entity, "left_semi").where(F.col("present") == 1).groupBy(
        "kind", "name").agg(F.countDistinct(entity).alias("n_with_value"))
    total = entities.select(entity).distinct().count()
    out = fields.join(have, ["kind", "name"], "left").select(
        "kind", "name", F.coalesce("n_with_value", F.lit(0)).cast("bigint").alias("n_with_value"),
        F.lit(total).cast("bigint").alias("n_total"))
    out = out.withColumn("complete", ((F.col("n_total") > 0) & (F.col("n_with_value") == F.col("n_total"))).cast("int"))
    if status is not None:
        out = out.join(status, ["kind", "name"], "left").withColumn(
            "status", F.coalesce("status", F.lit("missing")))
    return out


def unknown_fields(facts: DataFrame, fields: DataFrame) -> DataFrame:
    return facts.select("kind", "name").distinct().join(fields, ["kind", "name"], "left_anti")


def out_of_range(df: DataFrame, key: list[str], column: str, low: float, high: float) -> DataFrame:
    v = F.col(column)
    return df.where(v.isNull() | F.isnan(v.cast("double")) | (v < low) | (v > high)).select(
        *key, v.cast("double").alias("value"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def flag_mismatch(entities: DataFrame, ratings: DataFrame, entity: str, placeholder: float) -> DataFrame:
    """Entities whose no-data flag, placeholder flag and stored ratings disagree."""
    r = ratings.groupBy(entity).agg(F.count(F.when(F.col("rating") != placeholder, 1)).alias("__own"))
    j = entities.join(r, entity, "left")
    bad = (F.col("no_data") != F.col("placeholder_rating")) | (
        (F.col("no_data") == 1) & (F.coalesce("__own", F.lit(0)) > 0))
    return j.where(bad).select(entity, "no_data", "placeholder_rating")


def failure_list(checks: dict[tuple[str, str], tuple[str, DataFrame]]) -> DataFrame:
    """One row per failed field: ``{(kind, name): (status, offenders)}`` counted and united."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.lit(status).alias("status"), "n_rows")
        for (kind, name), (status, df) in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), counted).where(F.col("n_rows") > 0)


def correlated_pairs(wide: DataFrame, columns: list[str], bound: float = CORRELATION_FLAG) -> DataFrame:
    """Pairs of columns with |Pearson r| above the bound, all from one aggregate.

    ``columns`` are field names (a fixed catalogue), so the pairs do not grow with the data.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = wide.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r"))
                             for a, b in pairs]).alias("p"))
    return row.select(F.explode("p").alias("p")).select("p.*").where(F.abs("r") > bound)


def rebuilt_rate_gap(shots: DataFrame, entity: str, bucket: Column, made: Column, within: Column) -> DataFrame:
    """Per entity: the make rate over ``within`` and its rebuild from bucket shares and rates."""
    per = shots.where(within).groupBy(entity, bucket.alias("__b")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(made.cast("double")).alias("__m"))
    total = per.groupBy(entity).agg(F.sum("__n").alias("n"), F.sum("__m").alias("__all"),
                                    F.sum(F.col("__n") * (F.col("__m") / F.col("__n"))).alias("__re"))
    return total.select(entity, "n", (F.col("__all") / F.col("n")).alias("rate"),
                        (F.col("__re") / F.col("n")).alias("rebuilt"),
                        ((F.col("__re") - F.col("__all")) / F.col("n")).alias("gap"))


def last_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The latest row per key (audit rows written twice keep the last one)."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return picked.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def ordered_ids(df: DataFrame, keys: list[str], order: list[str], limit: int = ROWS_PER_TASK) -> DataFrame:
    """1-based position of every row inside its key."""
    cuts = plan_cuts(df, keys, order[0], limit)
    return ordered_scan(df, keys, order, {"position": ("sum", F.lit(1))}, cuts)
