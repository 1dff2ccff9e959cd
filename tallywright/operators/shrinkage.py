"""Empirical-Bayes shrinkage. Long input ``(stat, entity, x, n)``; every statistic of a family is
fitted in one grouped aggregate and joined back, so the cost does not grow with their number.

Priors are fitted by moments with population variances. NULL parameters stand for a point mass:
no spread beyond sampling noise, so everyone gets the mean. Fits that do not exist carry an
``error`` text instead of parameters and yield NULL values (see ``fit_failures``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import safe_div

# Fixed value: tolerance of the proportion guard.
GUARD_TOLERANCE = 1e-9
PRIOR_COLUMNS = ("stat", "family", "param1", "param2", "mean", "n_entities", "error")


def proportion_offenders(df: DataFrame, x: str = "x", n: str = "n") -> DataFrame:
    """Rows that cannot be a proportion: negative, undefined, or more successes than chances."""
    s, t = F.col(x), F.col(n)
    broken = s.isNull() | t.isNull() | F.isnan(s) | F.isnan(t) | (s < 0) | (t < 0)
    return df.where(broken | (s > t + GUARD_TOLERANCE))


def count_offenders(df: DataFrame, x: str = "x", n: str = "n") -> DataFrame:
    """Rows that cannot be a count over an exposure: negative or undefined."""
    s, t = F.col(x), F.col(n)
    return df.where(s.isNull() | t.isNull() | F.isnan(s) | F.isnan(t) | (s < 0) | (t < 0))


def _prior(fit: DataFrame, by: list[str], family: str, error: Column, **values: Column) -> DataFrame:
    params = {"param1": F.lit(None).cast("double"), "param2": F.lit(None).cast("double"), **values}
    ok = error.isNull()
    return fit.select(*by, F.lit(family).alias("family"),
                      *[F.when(ok, params[k]).alias(k) for k in ("param1", "param2", "mean")],
                      F.col("n_entities"), error.alias("error"))


def _known(*cols: Column) -> Column:
    test = F.lit(True)
    for c in cols:
        test = test & c.isNotNull() & ~F.isnan(c)
    return test


# ------------------------------------------------------------------ proportions
def fit_beta(df: DataFrame, by: list[str], x: str = "x", n: str = "n") -> DataFrame:
    s, t = F.col(x).cast("double"), F.col(n).cast("double")
    p = s / F.nullif(t, F.lit(0.0))
    broken = ~_known(s, t) | (s < 0) | (t < 0) | (s > t + GUARD_TOLERANCE)
    fit = df.groupBy(*by).agg(
        F.count(F.when(t > 0, 1)).alias("n_entities"), F.avg(F.when(t > 0, p)).alias("m"),
        F.var_pop(F.when(t > 0, p)).alias("spread"), F.avg(safe_div(p * (1 - p), t)).alias("noise"),
        F.count(F.when(broken, 1)).alias("offenders"))
    m, v = F.col("m"), F.col("spread") - F.col("noise")
    total = safe_div(m * (1 - m), v) - 1
    error = (F.when(F.col("offenders") > 0, F.concat(F.lit("guard: "), F.col("offenders").cast("string"),
                                                     F.lit(" rows are not proportions")))
             .when(F.col("n_entities") < 2, "fewer than two entities with opportunities")
             .when((m <= 0) | (m >= 1), "degenerate mean rate")
             .when((v > 0) & (total <= 0), "variance above the Bernoulli maximum"))
    return _prior(fit, by, "beta", error, param1=F.when(v > 0, m * total),
                  param2=F.when(v > 0, (1 - m) * total), mean=m)


def shrink_beta(df: DataFrame, priors: DataFrame, by: list[str], x: str = "x", n: str = "n",
                out: str = "value") -> DataFrame:
    a, b = F.col("param1"), F.col("param2")
    value = F.when(a.isNull(), F.col("mean")).otherwise((F.col(x) + a) / (F.col(n) + a + b))
    return _apply(df, priors, by, value, out)


# ------------------------------------------------------------------ counts per exposure
def fit_gamma(df: DataFrame, by: list[str], x: str = "x", n: str = "n") -> DataFrame:
    c, e = F.col(x).cast("double"), F.col(n).cast("double")
    rate = c / F.nullif(e, F.lit(0.0))
    broken = ~_known(c, e) | (c < 0) | (e < 0)
    fit = df.groupBy(*by).agg(
        F.count(F.when(e > 0, 1)).alias("n_entities"), F.avg(F.when(e > 0, rate)).alias("m"),
        F.var_pop(F.when(e > 0, rate)).alias("spread"), F.avg(F.when(e > 0, safe_div(F.lit(1.0), e))).alias("inverse"),
        F.count(F.when(broken, 1)).alias("offenders"))
    m = F.col("m")
    v = F.col("spread") - m * F.col("inverse")
    error = (F.when(F.col("offenders") > 0, F.concat(F.lit("guard: "), F.col("offenders").cast("string"),
                                                     F.lit(" negative or undefined counts")))
             .when(F.col("n_entities") < 2, "fewer than two entities with exposure")
             .when(m <= 0, "mean rate is zero"))
    return _prior(fit, by, "gamma", error, param1=F.when(v > 0, safe_div(m * m, v)), param2=m, mean=m)


def shrink_gamma(df: DataFrame, priors: DataFrame, by: list[str], x: str = "x", n: str = "n",
                 out: str = "value") -> DataFrame:
    k, m = F.col("param1"), F.col("mean")
    value = F.when(k.isNull(), m).otherwise((F.col(x) + k) / (F.col(n) + safe_div(k, m)))
    return _apply(df, priors, by, value, out)


# ------------------------------------------------------------------ differences
def fit_normal(df: DataFrame, by: list[str], d: str = "d", s2: str = "s2",
               estimate_mean: Column | bool = False) -> DataFrame:
    """``estimate_mean``: a flag per group, or one bool; False pins the prior mean to 0."""
    dev, noise = F.col(d).cast("double"), F.col(s2).cast("double")
    use = _known(dev, noise) & (noise > 0)
    free = estimate_mean if isinstance(estimate_mean, Column) else F.lit(estimate_mean)
    fit = df.groupBy(*by).agg(
        F.count(F.when(use, 1)).alias("n_entities"), F.avg(F.when(use, dev)).alias("m"),
        F.var_pop(F.when(use, dev)).alias("spread"), F.avg(F.when(use, noise)).alias("noise"),
        F.max(free).alias("free"))
    tau2 = F.greatest(F.lit(0.0), F.col("spread") - F.col("noise"))
    error = F.when(F.col("n_entities") < 2, "fewer than two entities with a defined difference")
    return _prior(fit, by, "normal", error, param1=tau2,
                  mean=F.when(F.col("free"), F.col("m")).otherwise(F.lit(0.0)))


def shrink_normal(df: DataFrame, priors: DataFrame, by: list[str], d: str = "d", s2: str = "s2",
                  out: str = "value") -> DataFrame:
    dev, noise, tau2, mean = F.col(d), F.col(s2), F.col("param1"), F.col("mean")
    use = _known(dev, noise) & (noise > 0) & (tau2 > 0)
    value = F.when(use, mean + (dev - mean) * tau2 / (tau2 + noise)).otherwise(mean)
    return _apply(df, priors, by, value, out)


# ------------------------------------------------------------------ relative risk
def fit_relative_risk(df: DataFrame, by: list[str], x: str = "x", n: str = "n") -> DataFrame:
    """``x`` observed events, ``n`` expected events."""
    o, e = F.col(x).cast("double"), F.col(n).cast("double")
    risk = o / F.nullif(e, F.lit(0.0))
    fit = df.groupBy(*by).agg(
        F.count(F.when(e > 0, 1)).alias("n_entities"), F.var_pop(F.when(e > 0, risk)).alias("spread"),
        F.avg(F.when(e > 0, safe_div(F.lit(1.0), e))).alias("inverse"))
    inv_k = F.greatest(F.lit(0.0), F.col("spread") - F.col("inverse"))
    error = F.when(F.col("n_entities") < 2, "fewer than two entities with expected events")
    return _prior(fit, by, "gamma_rr", error, param1=F.when(inv_k > 0, safe_div(F.lit(1.0), inv_k)), mean=F.lit(1.0))


def shrink_relative_risk(df: DataFrame, priors: DataFrame, by: list[str], x: str = "x",
                         n: str = "n", out: str = "value") -> DataFrame:
    k, e = F.col("param1"), F.col(n)
    value = F.when(k.isNull() | (e <= 0) | e.isNull(), F.lit(1.0)).otherwise((F.col(x) + k) / (e + k))
    return _apply(df, priors, by, value, out)


# ------------------------------------------------------------------ variances
def fit_scaled_inv_chi2(df: DataFrame, by: list[str], s2: str = "s2", n: str = "n") -> DataFrame:
    v_i, games = F.col(s2).cast("double"), F.col(n).cast("double")
    use = games >= 2
    fit = df.groupBy(*by).agg(
        F.count(F.when(use, 1)).alias("n_entities"), F.avg(F.when(use, v_i)).alias("m"),
        F.var_pop(F.when(use, v_i)).alias("spread"),
        F.avg(F.when(use, 2 * v_i * v_i / (games + 1))).alias("noise"))
    m, v = F.col("m"), F.col("spread") - F.col("noise")
    nu0 = 4 + safe_div(2 * m * m, v)
    scale = F.when(v > 0, m * (nu0 - 2) / nu0).otherwise(m)
    error = F.when(F.col("n_entities") < 2, "fewer than two entities with at least two games")
    return _prior(fit, by, "scaled_inv_chi2", error, param1=F.when(v > 0, nu0), param2=scale, mean=scale)


def shrink_variance(df: DataFrame, priors: DataFrame, by: list[str], s2: str = "s2", n: str = "n",
                    out: str = "value") -> DataFrame:
    nu0, scale = F.col("param1"), F.col("param2")
    dof = F.when(F.col(n) >= 2, F.col(n) - 1).otherwise(F.lit(0.0))
    own = F.when(dof > 0, F.col(s2)).otherwise(F.lit(0.0))
    value = F.when(nu0.isNull(), scale).otherwise((nu0 * scale + dof * own) / (nu0 + dof))
    return _apply(df, priors, by, value, out)


def _apply(df: DataFrame, priors: DataFrame, by: list[str], value: Column, out: str) -> DataFrame:
    # One prior row per statistic: Spark broadcasts it when it measures small enough.
    joined = df.join(priors.drop("family", "n_entities"), by)
    kept = [F.col(c) for c in df.columns if c != out]
    return joined.select(*kept, F.when(F.col("error").isNull(), value).alias(out))


FITS = {"beta": (fit_beta, shrink_beta), "gamma": (fit_gamma, shrink_gamma),
        "normal": (fit_normal, shrink_normal), "gamma_rr": (fit_relative_risk, shrink_relative_risk),
        "scaled_inv_chi2": (fit_scaled_inv_chi2, shrink_variance)}


def fit_failures(priors: DataFrame, by: list[str]) -> DataFrame:
    return priors.where(F.col("error").isNotNull()).select(*by, "family", "error")


def prior_registry(priors: DataFrame, by: list[str]) -> DataFrame:
    """One row per statistic in the published form: undefined parameters are NULL."""
    def finite(c):
        bad = F.isnan(F.col(c)) | (F.abs(F.col(c)) == float("inf"))
        return F.when(~bad, F.col(c)).alias(c)
    return priors.where(F.col("error").isNull()).select(
        *by, "family", finite("param1"), finite("param2"), finite("mean"), "n_entities")


def observed_minus_expected(df: DataFrame, by: list[str], made: str, prob: str) -> DataFrame:
    """Per group: d = (sum made - sum p) / n and its sampling variance sum p(1-p) / n^2."""
    p = F.col(prob)
    g = df.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(made).alias("y"),
                            F.sum(p).alias("p"), F.sum(p * (1 - p)).alias("v"))
    return g.select(*by, "n", safe_div(F.col("y") - F.col("p"), F.col("n")).alias("d"),
                    safe_div(F.col("v"), F.col("n") * F.col("n")).alias("s2"))


def mean_difference(df: DataFrame, by: list[str], entity: list[str], value: str) -> DataFrame:
    """Per entity: mean minus the mean of its ``by`` group (the statistic), with sampling variance
    (variance of the group) / n. The group's moments are pooled from the entities' own, so the rows
    are aggregated once."""
    g = df.groupBy(*by, *entity).agg(F.avg(value).alias("__own"), F.var_pop(value).alias("__in"),
                                     F.count(value).cast("double").alias("n"))
    n, own = F.col("n"), F.col("__own")
    pooled = g.groupBy(*by).agg((F.sum(n * own) / F.sum(n)).alias("__m"), (F.sum(n * F.col("__in")) / F.sum(n)).alias("__w"),
                                (F.sum(n * own * own) / F.sum(n)).alias("__q"))
    spread = F.col("__w") + F.greatest(F.lit(0.0), F.col("__q") - F.col("__m") * F.col("__m"))
    return g.join(pooled, by).select(*by, *entity, "n", (own - F.col("__m")).alias("d"), safe_div(spread, n).alias("s2"))
