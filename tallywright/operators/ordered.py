"""Ordered computations that survive a hot key.

A window over one key runs in one task. When a key holds more rows than ``limit``, its rows are
cut into order ranges (chunks) of about equal size, the window runs per (key, chunk), one summary
row per chunk is carried forward, and the two are combined. The cut points come from quantiles of
the order column over the hot rows only, so their number is (hot rows / limit), and keys below the
limit keep the plain single-window plan.
"""

from __future__ import annotations

import os.path
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions.scalars import micros

ROWS_PER_TASK = 2_000_000
CHUNK = "__chunk"
MAX_SPLITS = 4096


@dataclass(frozen=True)
class Cuts:
    """Which keys are hot, and where the order column is cut for them."""

    hot: DataFrame | None
    points: tuple
    skip: int = 0       # leading characters every value of a text order column shares


def hot_keys(df: DataFrame, keys: list[str], limit: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``limit`` rows: at most rows/limit of them, counted map-side first."""
    return df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)


def plan_cuts(df: DataFrame, keys: list[str], order: str, limit: int = ROWS_PER_TASK) -> Cuts:
    """Decide at plan time whether ``df`` needs chunks; ``order`` is the leading order column."""
    if not keys:
        rows = df.count()
        if rows <= limit:
            return Cuts(None, ())
        hot, hot_rows, source = None, rows, df
    else:
        sizes = df.groupBy(*keys).count().where(F.col("count") > limit)
        total = sizes.agg(F.sum("count")).first()[0]
        if total is None:
            return Cuts(None, ())
        hot_rows, hot = int(total), sizes.select(*keys)
        source = df.join(hot, keys, "left_semi")
    pieces = min(MAX_SPLITS, -(-hot_rows // limit))
    probs = [i / pieces for i in range(1, pieces)]
    skip = 0
    if dict(df.dtypes)[order] == "string":
        ends = source.agg(F.min(order), F.max(order)).first()
        skip = len(os.path.commonprefix([v or "" for v in ends]))
    value = order_number(df, order, skip)
    points = source.agg(F.percentile_approx(value, probs, 100_000).alias("p")).first()["p"] or []
    return Cuts(hot, tuple(sorted(set(points))), skip)


def order_number(df: DataFrame, order: str, skip: int = 0) -> Column:
    """A number that never decreases along the order column (text: the bytes after ``skip``)."""
    kind = dict(df.dtypes)[order]
    if kind == "string":
        head = F.substring(F.rpad(F.substring(order, skip + 1, 7), 7, " ").cast("binary"), 1, 7)
        return F.conv(F.hex(head), 16, 10).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return micros(order)
    if kind == "date":
        return F.unix_date(order)
    return F.col(order)


def with_chunk(df: DataFrame, order: str, cuts: Cuts | None) -> DataFrame:
    """Add the chunk number: 0 for ordinary keys, the order range for hot ones."""
    if cuts is None or not cuts.points:
        return df.withColumn(CHUNK, F.lit(0))
    points = F.array(*[F.lit(p) for p in cuts.points])
    bucket = F.size(F.filter(points, lambda p: p <= order_number(df, order, cuts.skip)))
    if cuts.hot is None:
        return df.withColumn(CHUNK, bucket)
    # the hot keys may be coarser than ``keys``: a hot game is cut for each of its players too
    flagged = cuts.hot.withColumn("__hot", F.lit(True))
    return (df.join(flagged, cuts.hot.columns, "left")
            .withColumn(CHUNK, F.when(F.col("__hot"), bucket).otherwise(0)).drop("__hot"))


def _order_columns(order: list[str]):
    return [F.col(o) if isinstance(o, str) else o for o in order]


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], outputs: dict,
                 cuts: Cuts | None = None) -> DataFrame:
    """Add running columns over ``keys`` in the total order ``order``.

    ``outputs`` maps a new column to ``(how, value)``: ``sum``, ``max`` and ``last`` include the row,
    ``sum_before``, ``last_before`` and ``previous`` do not; ``last*`` skip NULLs, ``previous`` does
    not; ``first`` is the first row's value. ``value`` is a Column or a name.
    """
    values = {name: (F.col(v) if isinstance(v, str) else v) for name, (_how, v) in outputs.items()}
    hows = {name: how for name, (how, _v) in outputs.items()}
    chunked = cuts is not None and bool(cuts.points)
    base = with_chunk(df, order[0], cuts) if chunked else df
    groups = keys + [CHUNK] if chunked else keys
    sort = _order_columns(order)
    # one struct keeps several running columns in a single sort of the group
    upto = W.partitionBy(*groups).orderBy(*sort).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*groups).orderBy(*sort).rowsBetween(W.unboundedPreceding, -1)
    own = {}
    for name, how in hows.items():
        v = values[name]
        own[name] = {
            "sum": lambda v=v: F.sum(v).over(upto),
            "max": lambda v=v: F.max(v).over(upto),
            "sum_before": lambda v=v: F.coalesce(F.sum(v).over(before), F.lit(0)),
            "last": lambda v=v: F.last(v, ignorenulls=True).over(upto),
            "last_before": lambda v=v: F.last(v, ignorenulls=True).over(before),
            "previous": lambda v=v: F.last(F.struct(v.alias("v"))).over(before),
            "first": lambda v=v: F.first(F.struct(v.alias("v"))).over(upto),
        }[how]()
    scanned = base.select("*", *[c.alias(n) for n, c in own.items()])
    if not chunked:
        for name, how in hows.items():
            if how in ("previous", "first"):
                scanned = scanned.withColumn(name, F.col(name)["v"])
        return scanned

    position = F.struct(*sort)
    partial = {}
    for name, how in hows.items():
        v = values[name]
        partial[name] = {
            "sum": F.sum(v), "sum_before": F.sum(v), "max": F.max(v),
            "last": F.max_by(v, F.when(v.isNotNull(), position)),
            "last_before": F.max_by(v, F.when(v.isNotNull(), position)),
            "previous": F.max_by(F.struct(v.alias("v")), position),
            "first": F.min_by(F.struct(v.alias("v")), position),
        }[how]
    chunks = base.groupBy(*groups).agg(*[c.alias(f"__{n}") for n, c in partial.items()])
    past = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = []
    for name, how in hows.items():
        part = F.col(f"__{name}")
        if how.startswith("sum"):
            carry.append(F.coalesce(F.sum(part).over(past), F.lit(0)).alias(f"__{name}"))
        elif how == "max":
            carry.append(F.max(part).over(past).alias(f"__{name}"))
        elif how == "first":
            carry.append(F.first(part, ignorenulls=True).over(past).alias(f"__{name}"))
        else:
            carry.append(F.last(part, ignorenulls=True).over(past).alias(f"__{name}"))
    carried = chunks.select(*groups, *carry)
    joined = scanned.join(carried, groups, "left")
    for name, how in hows.items():
        mine, past_value = F.col(name), F.col(f"__{name}")
        if how.startswith("sum"):
            merged = F.coalesce(mine, F.lit(0)) + past_value
        elif how == "max":
            merged = F.greatest(mine, past_value)
        elif how == "first":
            merged = F.coalesce(past_value, mine)["v"]
        elif how == "previous":
            merged = F.coalesce(mine, past_value)["v"]
        else:
            merged = F.coalesce(mine, past_value)
        joined = joined.withColumn(name, merged).drop(f"__{name}")
    return joined.drop(CHUNK)


def row_index(df: DataFrame, order: list[str], name: str = "row_index",
              limit: int = ROWS_PER_TASK) -> DataFrame:
    """0-based position in a total order, without sorting everything in one task when it is large."""
    cuts = plan_cuts(df, [], order[0], limit)
    keyed = df.withColumn("__all", F.lit(0))
    out = ordered_scan(keyed, ["__all"], order, {name: ("sum_before", F.lit(1).cast("bigint"))},
                       Cuts(None, cuts.points, cuts.skip))
    return out.withColumn(name, F.col(name).cast("bigint")).drop("__all")


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
