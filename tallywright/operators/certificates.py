"""Certificates of fitted models: how far each published coefficient is from satisfying its optimality condition.

A fit is only believed from the rows it was made on: the gradient of its penalized objective is summed anew over those rows, term by term, and divided by the
weight of the rows that carry the term, so that a solver that stopped early, lost rows or dropped a term shows in it. A term with a gradient of 0 everywhere
is the optimum of a convex fit. One grouped sum for each kind of term; nothing is gathered but the model itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.operators.models import _NUMERIC, RidgeFit, ShotModel, StintFit, _continuous
from tallywright.plans.lineage import cut

__all__ = ["shot_optimality", "stint_optimality", "ridge_optimality"]


def _share(gradient: Column, weight: Column) -> Column:
    return gradient / F.greatest(weight, F.lit(1e-300))


def shot_optimality(shots: DataFrame, model: ShotModel, made: str = "made") -> DataFrame:
    """term, label, n, gradient of every label of the rows, every numeric term and the intercept.

    A label that the model lacks shows with its whole gradient.
    """
    rows = shots.withColumn("miss", F.col(made).cast("double") - model.probability())
    out = rows.agg(F.lit("intercept").alias("term"), F.lit(None).cast("string").alias("label"), F.count(F.lit(1)).alias("n"), _share(F.sum("miss"), F.count(F.lit(1))).alias("gradient"))
    for name, table in model.labels.items():
        held = F.create_map(*[F.lit(v) for pair in table.items() for v in pair])
        label = F.col(name).cast("string")
        own = F.coalesce(F.try_element_at(held, F.col("label")), F.lit(0.0))
        part = rows.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum("miss").alias("g"))
        out = out.unionByName(part.select(F.lit(name).alias("term"), "label", "n", _share(F.col("g") - model.penalty * own, F.col("n")).alias("gradient")))
    for name in _NUMERIC:
        slope, mean, sd = model.slopes[name]
        part = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("miss") * (_continuous(name) - mean) / sd).alias("g"))
        out = out.unionByName(part.select(F.lit(name).alias("term"), F.lit(None).cast("string").alias("label"), "n", _share(F.col("g") - model.penalty * slope, F.col("n")).alias("gradient")))
    return out


def stint_optimality(stints: DataFrame, fits: dict[str, StintFit], entity: str = "entity_id") -> DataFrame:
    """target, entity, side, weight, gradient for everyone in a lineup of rows (offense, defense, w, targets).

    What a row misses is its totals less the sums of its two lineups, which are made once per lineup; it is summed by lineup before it is spread to players.
    """
    names, keys = list(fits), [entity, "side"]
    whole = stints.where((F.col("w") > 0) & F.col("offense").isNotNull() & F.col("defense").isNotNull())
    rows = cut(whole.select("w", *names, *[F.transform(c, lambda p: p.cast("bigint")).alias(c) for c in ("offense", "defense")]))
    betas = None
    for t, fit in fits.items():
        both = fit.coefficients.select(entity, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("b")) for s in ("offense", "defense")])).alias("x"))
        both = both.select(entity, "x.side", F.coalesce("x.b", F.lit(0.0)).alias(f"b_{t}"))
        betas = both if betas is None else betas.join(both, keys, "full")
    betas = cut(betas)
    made = rows
    for side in ("offense", "defense"):
        lineups = rows.select(side).distinct().select(side, F.explode_outer(side).alias(entity))
        own = betas.where(F.col("side") == side).drop("side")
        made = made.join(cut(lineups.join(own, entity, "left").groupBy(side).agg(*[F.coalesce(F.sum(f"b_{t}"), F.lit(0.0)).alias(f"{side}_{t}") for t in names])), side)
    missed = [(100.0 * F.col(t) - F.col("w") * (F.lit(fits[t].intercept) + F.col(f"offense_{t}") + F.col(f"defense_{t}"))).alias(f"m_{t}") for t in names]
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("lineup")) for s in ("offense", "defense")]))
    sums = lambda: [F.sum("w").alias("w"), *[F.sum(f"m_{t}").alias(f"m_{t}") for t in names]]
    spread = made.select("w", *missed, sides.alias("x")).groupBy("x.side", "x.lineup").agg(*sums()).select("side", F.explode("lineup").alias(entity), "w", *[f"m_{t}" for t in names])
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), (F.col(f"m_{t}") - fits[t].penalty * F.coalesce(f"b_{t}", F.lit(0.0))).alias("g")) for t in names]))
    found = spread.groupBy(*keys).agg(*sums()).join(betas, keys, "left").select(*keys, F.col("w").alias("weight"), each.alias("x"))
    return found.select("x.target", entity, "side", "weight", _share(F.col("x.g"), F.col("weight")).alias("gradient"))


def ridge_optimality(df: DataFrame, fit: RidgeFit, features: dict[str, Column], y: str) -> DataFrame:
    """term, n, gradient of every feature and the intercept over the rows that have a value."""
    miss = F.col(y) - fit.predict(list(features.values()))
    rows = df.where(F.col(y).isNotNull())
    terms = {"intercept": F.lit(1.0)} | {name: (c - float(fit.mean[j])) / float(fit.sd[j]) for j, (name, c) in enumerate(features.items())}
    pull = [0.0, *(fit.penalty * float(b) for b in fit.beta[1:])]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(miss * c).alias(f"g{j}") for j, c in enumerate(terms.values())])
    each = F.array(*[F.struct(F.lit(name).alias("term"), (F.col(f"g{j}") - pull[j]).alias("g")) for j, name in enumerate(terms)])
    return sums.select("n", F.explode(each).alias("x")).select("x.term", "n", _share(F.col("x.g"), F.col("n")).alias("gradient"))
