"""Ordered logs outside the game walk: runs, stretches, intervals and carried state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import micros, safe_div
from tallywright.operators.ordered import ROWS_PER_TASK, hot_keys, ordered_scan, plan_cuts
from tallywright.plans.lineage import cut


def runs_test(df: DataFrame, entity: str, order: list[str], success: Column,
              limit: int = ROWS_PER_TASK) -> DataFrame:
    """Runs test per entity over its ordered outcomes: n, n1, n2, runs, mu, z_runs (0 when the test
    has no spread)."""
    rows = df.select(entity, *order, success.cast("int").alias("__s"))
    cuts = plan_cuts(rows, [entity], order[0], limit)
    seen = ordered_scan(rows, [entity], order, {"__p": ("previous", "__s")}, cuts)
    g = seen.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__s").cast("bigint").alias("n1"),
        (1 + F.count(F.when(F.col("__s") != F.col("__p"), 1))).cast("bigint").alias("runs"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    g = g.withColumn("n2", F.col("n") - F.col("n1"))
    g = g.withColumn("mu", safe_div(2 * n1 * n2, n1 + n2) + 1)
    var = safe_div((F.col("mu") - 1) * (F.col("mu") - 2), n1 + n2 - 1)
    z = F.when((n1 > 0) & (n2 > 0) & (var > 0), safe_div(F.col("runs") - F.col("mu"), F.sqrt(F.abs(var)))).otherwise(0.0)
    return g.withColumn("z_runs", z)


def marks_to_intervals(df: DataFrame, keys: list[str], order: list[str], at: str, starts: Column, ends: Column,
                       close: Column, limit: int = ROWS_PER_TASK) -> DataFrame:
    """Half-open stretches per key: each start runs to the next mark of either kind, else ``close``.

    Scanned backwards, so "next mark" is the last one seen; order columns must be numeric or times.
    """
    marks = df.where(starts | ends).withColumn("__start", starts)
    back = [f"__b{i}" for i in range(len(order))]
    kinds = dict(df.dtypes)
    for b, o in zip(back, order):
        number = micros(o) if kinds[o].startswith("timestamp") else F.col(o)
        marks = marks.withColumn(b, -number)
    cuts = plan_cuts(marks, keys, back[0], limit)
    seen = ordered_scan(marks, keys, back, {"__next": ("previous", at)}, cuts)
    return seen.where("__start").withColumn("start_at", F.col(at)).withColumn(
        "end_at", F.coalesce("__next", close)).drop("__start", "__next", *back)


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str,
                  width: float) -> DataFrame:
    """Points inside half-open intervals of the same key.

    Both sides are cut into bins of ``width`` along the axis and joined on (key, bin): a key with
    very many points spreads over its bins, and no pair outside a bin is ever formed.
    """
    cell = F.floor(F.col(at) / F.lit(width)).cast("bigint")
    p = points.withColumn("__bin", cell)
    first = F.floor(F.col(start) / F.lit(width)).cast("bigint")
    last = F.floor(F.col(end) / F.lit(width)).cast("bigint")
    i = intervals.where(F.col(end) > F.col(start)).withColumn("__bin", F.explode(F.sequence(first, last)))
    return p.join(i, [*keys, "__bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("__bin")


def sums_within(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, values: dict,
                carried: list[str], limit: int = ROWS_PER_TASK) -> DataFrame:
    """Per interval (its keys and ``carried`` columns): sums of ``values`` over the points with start <= at < end.

    Running sums of the points are read at both ends of each interval, so no point ever meets an interval.
    """
    nothing = {n: F.lit(0).cast(t) for n, t in points.select(*[c.alias(n) for n, c in values.items()]).dtypes}
    here = points.select(*keys, F.col(at).alias("__at"), F.lit(1).alias("__rank"), *[F.coalesce(c, nothing[n]).alias(n) for n, c in values.items()])
    ends = intervals.where(F.col(start) < F.col(end)).select(*keys, *carried, F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(-1).alias("sign")), F.struct(F.col(end).alias("at"), F.lit(1).alias("sign")))).alias("x")).select(*keys, *carried, F.col("x.at").alias("__at"), F.col("x.sign").alias("__sign"), F.lit(0).alias("__rank"))
    both = here.unionByName(ends, allowMissingColumns=True)
    scanned = ordered_scan(both, keys, ["__at", "__rank"], {f"__{n}": ("sum_before", F.coalesce(F.col(n), nothing[n])) for n in values},
                           plan_cuts(both, keys, "__at", limit))
    return scanned.where("__rank = 0").groupBy(*keys, *carried).agg(*[F.sum(F.col("__sign") * F.col(f"__{n}")).alias(n) for n in values])


def split_at_changes(df: DataFrame, keys: list[str], order: list[str], change: Column, out: str = "segment",
                     limit: int = ROWS_PER_TASK) -> DataFrame:
    """Number the segments between rows where ``change`` holds."""
    cuts = plan_cuts(df, keys, order[0], limit)
    return ordered_scan(df, keys, order, {out: ("sum", F.when(change, 1).otherwise(0).cast("bigint"))}, cuts)


def carry(df: DataFrame, keys: list[str], order: list[str], signals: dict, limit: int = ROWS_PER_TASK) -> DataFrame:
    """State before each row: ``signals`` maps a name to a Column that is NULL where nothing changes."""
    cuts = plan_cuts(df, keys, order[0], limit)
    return ordered_scan(df, keys, order, {k: ("last_before", v) for k, v in signals.items()}, cuts)


def next_answer(df: DataFrame, keys: list[str], order: list[str], asks: Column, answers: Column,
                resets: Column, value: Column, limit: int = ROWS_PER_TASK) -> DataFrame:
    """Answer rows whose pending ask is the latest signal: adds ``asked`` (the ask's value) to them.

    An ask stays pending until an answer or a reset; a reset clears it without an answer.
    """
    signal = F.when(asks, F.struct(value.alias("v"))).when(
        answers | resets, F.struct(F.lit(None).cast(df.select(value.alias("v")).dtypes[0][1]).alias("v")))
    seen = carry(df, keys, order, {"__ask": signal}, limit)
    return seen.where(answers).withColumn("asked", F.col("__ask.v")).drop("__ask")


def latest_per_column(df: DataFrame, entity: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per entity and column, the value of the latest row that has one (map-side ``max_by``)."""
    position = F.struct(*order)
    return df.groupBy(entity).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns])


def resolve_names(spoken: DataFrame, roster: DataFrame, keys: list[str], name: str, entity: str,
                  later: DataFrame | None = None, order: str = "ord", limit: int = ROWS_PER_TASK) -> DataFrame:
    """Name to entity within a key: unique names directly; names several entities share go to the
    one that acts next (``later``: keys, entity, order). Unresolved names keep NULL.

    Acts get their names, then asks and acts of a name are united and scanned once from the end: rows stay as many as they are, and an ask
    carries its columns through the scan. A pool keeps two of its entities, which tell whether a name is shared.
    """
    pool = roster.groupBy(*keys, name).agg(F.min(entity).alias("__least"), F.max(entity).alias("__most")).where(F.col("__least").isNotNull())
    single = F.when(F.col("__least") == F.col("__most"), F.col("__least"))
    if later is None:
        return spoken.join(pool, [*keys, name], "left").withColumn("resolved", single).drop("__least", "__most")
    pool = cut(pool)
    j = spoken.join(pool, [*keys, name], "left")
    several = F.coalesce(F.col("__least") < F.col("__most"), F.lit(False))
    columns = list(dict.fromkeys([*keys, order, name, *spoken.columns]))
    plain = j.where(~several).withColumn("resolved", single).select(*columns, "resolved")
    shared = pool.where(several).select(*keys, name)
    named = roster.select(*keys, name, entity).join(shared, [*keys, name], "left_semi").distinct()
    acts = later.join(named, [*keys, entity]).select(*keys, name, F.col(entity).alias("__id"), (-F.col(order)).alias("__back"))
    asks = j.where(several).select(*keys, name, F.lit(None).cast(dict(acts.dtypes)["__id"]).alias("__id"), (-F.col(order)).alias("__back"),
                                   F.struct(*columns).alias("__ask"))
    both = asks.unionByName(acts, allowMissingColumns=True)
    # a name has no more rows than its key; only where a key has too many are those of its names counted
    loads = later.select(*keys).unionByName(spoken.select(*keys))
    cuts = None if hot_keys(loads, keys, limit).isEmpty() else plan_cuts(both, [*keys, name], "__back", limit)
    # one pass per name from the end; at equal positions the ask comes first, so an act on the same row does not count as later
    seen = ordered_scan(both, [*keys, name], ["__back", F.col("__ask").isNull(), -F.col("__id")], {"__who": ("last", "__id")}, cuts)
    return plain.unionByName(seen.where(F.col("__ask").isNotNull()).select("__ask.*", F.col("__who").alias("resolved")))
