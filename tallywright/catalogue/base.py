"""Registration helpers shared by the catalogue modules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions.scalars import AS241

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) query and, where SQL can say it, the SQL it must agree with."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(col, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0.0 turns -0.0 into 0.0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rq(expr: str, digits: int = 6) -> str:
    return f"round(cast({expr} as double), {digits}) + 0.0"


def _poly(coefs, x: str) -> str:
    return reduce(lambda acc, k: f"({acc} * {x} + {k!r}::double)", list(reversed(coefs))[1:], f"{coefs[-1]!r}::double")


def probit_sql(p: str) -> str:
    """The AS241 formula as SQL text over a probability expression (kept short by a column name)."""
    q = f"({p} - 0.5)"
    rr = f"sqrt(-ln(least({p}, 1 - {p})))"
    mid = f"({q} * {_poly(AS241['a'], f'(0.180625 - {q} * {q})')} / {_poly(AS241['b'], f'(0.180625 - {q} * {q})')})"
    near = f"({_poly(AS241['c'], f'({rr} - 1.6)')} / {_poly(AS241['d'], f'({rr} - 1.6)')})"
    far = f"({_poly(AS241['e'], f'({rr} - 5.0)')} / {_poly(AS241['f'], f'({rr} - 5.0)')})"
    return (f"case when abs({q}) <= 0.425 then {mid} else sign({q}) * "
            f"case when {rr} <= 5.0 then {near} else {far} end end")
