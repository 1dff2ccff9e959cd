"""Shrinkage families (G) and models (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.aggregate_queries import ITEMS, items
from tallywright.catalogue.base import r, register, rq, table
from tallywright.catalogue.order_queries import SHRUNK, successes
from tallywright.operators import certificates as ct
from tallywright.operators import models as md
from tallywright.operators import shrinkage as sh
from tallywright.plans.profile import union_all


def family(long, name, keep="entity", digits=6):
    fit, shrink = sh.FITS[name]
    return shrink(long, fit(long, ["stat"]), ["stat"]).select(keep, r("value", digits).alias("value"))


@register("g1_beta_binomial", f"select l_partkey, {rq('value')} as value from {SHRUNK} t")
def beta(spark, sf):
    return family(successes(spark, sf), "beta", "l_partkey")


@register("g1_point_mass", f"""
    with c as (select l_suppkey, sum(case when l_returnflag = 'R' then 1 else 0 end)::double as x, count(*)::double as n from lineitem group by l_suppkey),
    p as (select avg(x / n) as m, var_pop(x / n) - avg(x / n * (1 - x / n) / n) as v from c)
    select l_suppkey as entity, {rq('case when v > 0 then (x + m * (m * (1 - m) / v - 1)) / (n + m * (1 - m) / v - 1) else m end')} as value from c, p""")
def point_mass(spark, sf):
    """No spread beyond sampling noise: everyone gets the mean."""
    c = table(spark, sf, "lineitem").groupBy(F.lit("r").alias("stat"), F.col("l_suppkey").alias("entity")).agg(
        F.sum((F.col("l_returnflag") == "R").cast("double")).alias("x"), F.count(F.lit(1)).cast("double").alias("n"))
    return family(c, "beta")


RATES = f"(select l_partkey as entity, count(*)::double as x, max(p_size)::double as n from {ITEMS} group by l_partkey)"


def rates(spark, sf):
    return items(spark, sf).groupBy(F.lit("per size").alias("stat"), F.col("l_partkey").alias("entity")).agg(
        F.count(F.lit(1)).cast("double").alias("x"), F.max("p_size").cast("double").alias("n"))


@register("g2_gamma_poisson", f"""
    with p as (select avg(x / n) as m, var_pop(x / n) - avg(x / n) * avg(1 / n) as v from {RATES} c)
    select entity, {rq('case when v > 0 then (x + m * m / v) / (n + m / v) else m end')} as value from {RATES} c, p""")
def gamma(spark, sf):
    return family(rates(spark, sf), "gamma")


@register("g3_normal_normal", f"""
    with d as (select l_partkey as entity, avg(v) - any_value(m) as d, any_value(s) / count(*) as s2 from (select l_partkey, l_quantity - p_size as v,
        avg(l_quantity - p_size) over () as m, var_pop(l_quantity - p_size) over () as s from {ITEMS}) t group by l_partkey),
    p as (select greatest(0, var_pop(d) - avg(s2)) as t2, avg(d) as mu from d)
    select entity, {rq('case when t2 > 0 then d * t2 / (t2 + s2) else 0 end')} as value,
      {rq('case when t2 > 0 then mu + (d - mu) * t2 / (t2 + s2) else mu end')} as value_free from d, p""")
def normal(spark, sf):
    s = items(spark, sf).select(F.lit("q").alias("stat"), F.col("l_partkey").alias("entity"), (F.col("l_quantity") - F.col("p_size")).alias("v"))
    d = sh.mean_difference(s, ["stat"], ["entity"], "v")
    out = sh.shrink_normal(d, sh.fit_normal(d, ["stat"]), ["stat"])
    free = sh.shrink_normal(out, sh.fit_normal(d, ["stat"], estimate_mean=True), ["stat"], out="value_free")
    return free.select("entity", r("value").alias("value"), r("value_free").alias("value_free"))


@register("g4_relative_risk", f"""
    with e as (select entity, x as o, n * (select sum(x) / sum(n) from {RATES} a) as e from {RATES} c),
    p as (select greatest(0, var_pop(o / e) - avg(1 / e)) as ik from e)
    select entity, {rq('case when ik > 0 then (o + 1 / ik) / (e + 1 / ik) else 1 end')} as value from e, p""")
def risk(spark, sf):
    c = rates(spark, sf)
    rate = c.agg((F.sum("x") / F.sum("n")).alias("k")).first()["k"]
    return family(c.withColumn("n", F.col("n") * F.lit(rate)), "gamma_rr")


@register("g5_scaled_inverse_chi2", f"""
    with g as (select user_id as entity, event_type as cluster, coalesce(var_samp(value), 0) as s2, count(*)::double as n from events group by all),
    p as (select cluster, avg(s2) as m, var_pop(s2) - avg(2 * s2 * s2 / (n + 1)) as v from g where n >= 2 group by cluster),
    q as (select *, 4 + 2 * m * m / nullif(v, 0) as nu from p)
    select entity, g.cluster as cluster, {rq('''case when v <= 0 then m else (nu * (m * (nu - 2) / nu) + case when n >= 2 then (n - 1) * s2 else 0 end)
      / (nu + case when n >= 2 then n - 1 else 0 end) end''', 3)} as value from g join q on g.cluster = q.cluster""")
def variance(spark, sf):
    """Variance per user, shrunk inside each event type."""
    g = table(spark, sf, "events").groupBy(F.col("user_id").alias("entity"), F.col("event_type").alias("cluster")).agg(
        F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("s2"), F.count(F.lit(1)).cast("double").alias("n"))
    return sh.shrink_variance(g, sh.fit_scaled_inv_chi2(g, ["cluster"]), ["cluster"]).select("entity", "cluster", r("value", 3).alias("value"))


@register("g6_prior_registry", f"""
    with b as (select avg(x / n) as m, var_pop(x / n) - avg(x / n * (1 - x / n) / n) as v, count(*) as k from (select sum(case when l_quantity > p_size then 1 else 0 end)::double as x,
      count(*)::double as n from {ITEMS} group by l_partkey) t), g as (select avg(x / n) as m, var_pop(x / n) - avg(x / n) * avg(1 / n) as v, count(*) as k from {RATES} c)
    select 'rate' as stat, 'beta' as family, {rq('case when v > 0 then m * (m * (1 - m) / v - 1) end', 5)} as param1,
      {rq('case when v > 0 then (1 - m) * (m * (1 - m) / v - 1) end', 5)} as param2, {rq('m')} as mean, k as n_entities from b
    union all select 'per size', 'gamma', {rq('case when v > 0 then m * m / v end', 5)}, {rq('m', 5)}, {rq('m')}, k from g""")
def registry(spark, sf):
    reg = sh.prior_registry(union_all([sh.fit_beta(successes(spark, sf), ["stat"]), sh.fit_gamma(rates(spark, sf), ["stat"])]), ["stat"])
    return reg.select("stat", "family", r("param1", 5).alias("param1"), r("param2", 5).alias("param2"), r("mean").alias("mean"), "n_entities")


def shots(spark, sf):
    """Line items as shots: game = order, labels = part type and return flag."""
    return items(spark, sf).select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"), F.col("p_type").alias("action"),
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("kind"), F.floor(F.col("l_quantity") / 2).alias("distance"),
        (F.col("l_discount") * 100).alias("x"), (F.col("l_quantity") + 5 * F.col("l_linenumber") > F.col("p_size") + 20).cast("int").alias("made"),
        (F.col("l_linenumber") + F.col("l_tax") * 10).alias("minutes"))


@register("h1_shot_model")
def shot_model(spark, sf):
    """Expected make rate per supplier from the cross-validated ridge logistic, against the observed."""
    s = shots(spark, sf)
    m = md.fit_shot_model(s, ["action", "area"])
    d = sh.observed_minus_expected(s.withColumn("p", m.probability()), ["player_id"], "made", "p")
    return d.select("player_id", "n", r("d", 5).alias("d"), r("s2", 7).alias("s2"), F.lit(m.penalty).alias("penalty"))


@register("h2_shot_logit")
def shot_logit(spark, sf):
    """Mean logit per shot kind from the model with the kind added."""
    s = shots(spark, sf)
    m = md.fit_shot_model(s, ["action", "area", "kind"])
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), m.probability()))
    return s.withColumn("logit", F.log(p / (1 - p))).groupBy("kind", "made").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("logit"), 4).alias("mean_logit"))


def supplier_stints(spark, sf):
    """Line items as stints; lineups are five neighbouring suppliers."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax")
    n = table(spark, sf, "supplier").count()
    five = F.sequence(F.lit(0), F.lit(4))
    return li.select(F.col("l_orderkey").alias("game_id"),
                   F.transform(five, lambda i: F.pmod(F.col("l_suppkey") + i, F.lit(n))).alias("offense"),
                   F.transform(five, lambda i: F.pmod(F.col("l_partkey") * 7 + i, F.lit(n))).alias("defense"),
                   F.col("l_linenumber").cast("double").alias("w"), F.col("l_quantity").alias("pts"), (F.col("l_tax") * 10).alias("sq"))


def zero(name, digits):
    """A rounded number without a sign on 0."""
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


def shot_terms_sql(labels):
    parts = [f"select '{c}' as term, {col} as label, count(*) as n, 0.0::double as gradient from {ITEMS} group by {col}" for c, col in labels.items()]
    parts += [f"select '{t}', null, count(*), 0.0 from {ITEMS}" for t in ("intercept", "distance", "distance_sq", "side")]
    return " union all ".join(parts)


LABELS = {"action": "p_type", "area": "l_returnflag", "kind": "l_linestatus"}


def shot_certificate(count):
    def run(spark, sf):
        """Every term of the model with its rows; the gradient of the fit, summed anew over the rows, is 0 per row."""
        s = shots(spark, sf)
        model = md.fit_shot_model(s, list(LABELS)[:count])
        return ct.shot_optimality(s, model).select("term", "label", "n", zero("gradient", 7))
    return run


register("h1_shot_optimality", shot_terms_sql(dict(list(LABELS.items())[:2])))(shot_certificate(2))
register("h2_shot_logit_optimality", shot_terms_sql(LABELS))(shot_certificate(3))


@register("h3_stint_ridge")
def stint_ridge(spark, sf):
    """Offense and defense coefficient per supplier."""
    fits = md.fit_stint_ridges(supplier_stints(spark, sf), ["pts", "sq"])
    parts = [f.coefficients.select(F.lit(t).alias("target"), "entity_id", r("offense", 4).alias("offense"), r("defense", 4).alias("defense"),
                                   F.lit(f.penalty).alias("penalty")) for t, f in fits.items()]
    return union_all(parts)


@register("h3_stint_optimality", """
    with n as (select count(*) as n from supplier), i as (select unnest(range(5)) as i),
    o as (select (l_suppkey + i) % n.n as e, 'offense' as side, l_linenumber as w from lineitem, n, i union all
      select (l_partkey * 7 + i) % n.n, 'defense', l_linenumber from lineitem, n, i)
    select t.target, e as entity_id, side, sum(w)::double as weight, 0.0::double as gradient from o, (values ('pts'), ('sq')) as t(target) group by all""")
def stint_optimality(spark, sf):
    """Everyone in a lineup with the weight of their rows; the gradient of the fit, summed anew over the rows, is 0 per unit of weight."""
    st = supplier_stints(spark, sf)
    return ct.stint_optimality(st, md.fit_stint_ridges(st, ["pts", "sq"])).select("target", "entity_id", "side", "weight", zero("gradient", 6))


@register("h4_poisson_exposure", f"""
    with c as (select l_partkey as entity, count(*)::double as y, max(p_size)::double as e, max(case when p_type in ('PROMO', 'ECONOMY') then 1.0 else 0.0 end) as g
      from {ITEMS} group by l_partkey) select entity, {rq('e * sum(y) over (partition by g) / sum(e) over (partition by g)', 5)} as expected from c""")
def poisson(spark, sf):
    """One yes/no covariate: expected = exposure times the rate of its group."""
    c = items(spark, sf).groupBy(F.col("l_partkey").alias("entity")).agg(
        F.count(F.lit(1)).cast("double").alias("y"), F.max("p_size").cast("double").alias("e"),
        F.max(F.col("p_type").isin("PROMO", "ECONOMY").cast("double")).alias("g"))
    fit = md.fit_poisson(c, "y", "e", ["g"])
    return c.select("entity", r(md.poisson_expected(fit, "e"), 5).alias("expected"))


@register("h5_blend_weights", f"""
    with w as (select avg(l_quantity) - 0.5 * max(p_size) + 2 * sum(l_tax) as t, max(-p_size)::double as a, sum(l_tax) as b from {ITEMS} group by l_partkey),
    m as (select var_pop(a) as aa, var_pop(b) as bb, covar_pop(a, b) as ab, covar_pop(a, t) as ca, covar_pop(b, t) as cb from w),
    s as (select (bb * ca - ab * cb) / (aa * bb - ab * ab) as u, (aa * cb - ab * ca) / (aa * bb - ab * ab) as v, ca / aa as ua, cb / bb as vb,
      ca * ca / aa as ga, cb * cb / bb as gb, ca, cb from m),
    f as (select case when u >= 0 and v >= 0 then u when ca > 0 and (cb <= 0 or ga >= gb) then ua else 0 end as wa,
      case when u >= 0 and v >= 0 then v when ca > 0 and (cb <= 0 or ga >= gb) then 0 else greatest(vb, 0) end as wb from s)
    select 'a' as component, {rq('wa / (wa + wb)')} as weight from f union all select 'b', {rq('wb / (wa + wb)')} from f""")
def blend(spark, sf):
    w = items(spark, sf).groupBy("l_partkey").agg((F.avg("l_quantity") - 0.5 * F.max("p_size") + 2 * F.sum("l_tax")).alias("t"), F.max(-F.col("p_size")).cast("double").alias("a"),
                                                  F.sum("l_tax").alias("b"))
    weights = md.blend_weights(w, ["a", "b"], "t")
    return spark.createDataFrame(list(weights.items()), "component string, weight double").select("component", r("weight").alias("weight"))


@register("h6_ols_residual", f"""
    with g as (select l_partkey, avg(l_quantity) as y, max(p_size) as x, max(p_type) as k from {ITEMS} group by l_partkey),
    f as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from g)
    select l_partkey, {rq('y - a - b * x')} as residual, {rq('y - avg(y) over (partition by k)')} as within_type from g, f""")
def residual(spark, sf):
    """On one covariate, and on a full set of indicators (collinear with the intercept)."""
    g = items(spark, sf).groupBy("l_partkey").agg(F.avg("l_quantity").alias("y"), F.max("p_size").cast("double").alias("x"), F.max("p_type").alias("k"))
    g = md.ols_residual(g, "y", [F.col("x")])
    g = md.ols_residual(g, "y", md.one_hot(g, "k"), "within_type")
    return g.select("l_partkey", r("residual").alias("residual"), r("within_type").alias("within_type"))


@register("h7_ridge_imputation")
def ridge(spark, sf):
    """Missing part prices filled from size, name length and type by cross-validated ridge."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.length("p_name").cast("double").alias("len"),
                                        "p_type", F.when(F.col("p_partkey") % 4 != 0, F.col("p_retailprice") + 3 * F.col("p_size")).alias("y"))
    feats = [F.col("size"), F.col("len"), *md.one_hot(p, "p_type")]
    fit = md.fit_ridge(p, feats, "y", ["p_partkey"])
    return p.select("p_partkey", r(F.coalesce("y", fit.predict(feats)), 3).alias("filled"), F.col("y").isNull().cast("int").alias("imputed"))


@register("h7_ridge_optimality", """
    with p as (select count(*) as n from part where p_partkey % 4 <> 0)
    select term, n, 0.0::double as gradient from p, (select unnest(['intercept', 'size', 'len']) as term union all select 'type ' || p_type from part group by p_type)""")
def ridge_certificate(spark, sf):
    """Every term of the imputation with the rows it was fitted on; the gradient of the fit is 0 per row."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.length("p_name").cast("double").alias("len"),
                                        "p_type", F.when(F.col("p_partkey") % 4 != 0, F.col("p_retailprice") + 3 * F.col("p_size")).alias("y"))
    kinds = sorted(x[0] for x in p.select("p_type").distinct().collect())
    features = {"size": F.col("size"), "len": F.col("len")} | {f"type {k}": F.when(F.col("p_type") == k, 1.0).otherwise(0.0) for k in kinds}
    fit = md.fit_ridge(p, list(features.values()), "y", ["p_partkey"])
    return ct.ridge_optimality(p, fit, features, "y").select("term", "n", zero("gradient", 7))


def _newton_sql(steps: int = 12) -> str:
    """The same Newton steps unrolled: one grouped sum and one 2x2 system each."""
    out = ["""s as (select l_suppkey as e, (l_linenumber + l_tax * 10)::double as x, (25 - floor(l_quantity / 2)) / 20.0 as o,
      case when l_quantity + 5 * l_linenumber > p_size + 20 then 1.0 else 0.0 end as y from lineitem join part on p_partkey = l_partkey)""",
           "n0 as (select e, 0.0::double as a, 0.0::double as b, 0.0::double as se from s group by e having count(*) >= 3 and sum(y) between 1 and count(*) - 1 and max(x) > min(x))"]
    for k in range(steps):
        out.append(f"""h{k} as (select s.e, any_value(n.a) as a, any_value(n.b) as b, sum(y - p) as g0, sum((y - p) * x) as g1, sum(p * (1 - p)) as h00, sum(p * (1 - p) * x) as h01,
      sum(p * (1 - p) * x * x) as h11 from (select s.*, n.a, n.b, 1 / (1 + exp(-greatest(-30, least(30, o + n.a + n.b * x)))) as p from s join n{k} n on n.e = s.e) s join n{k} n on n.e = s.e group by s.e)""")
        out.append(f"""n{k + 1} as (select e, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) as a, b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) as b,
      sqrt(h00 / (h00 * h11 - h01 * h01)) as se from h{k})""")
    last = f"n{steps}"
    return (f"with {', '.join(out)} select e as player_id, {rq('b', 5)} as slope, {rq('se', 5)} as se from (select s.e, {last}.b, {last}.se "
            f"from (select distinct e from s) s left join {last} on {last}.e = s.e) t")


@register("h8_entity_slopes", _newton_sql())
def slopes(spark, sf):
    """Slope of making a shot on minutes per supplier, with an offset."""
    s = shots(spark, sf).withColumn("offset", (25 - F.col("distance")) / 20)
    return md.entity_slopes(s, "player_id", "made", "minutes", "offset").select(
        "player_id", r("slope", 5).alias("slope"), r("se", 5).alias("se"))


@register("h9_mixture")
def mixture(spark, sf):
    """Users clustered on three activity features; the number of clusters by BIC."""
    e = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("mean"), F.avg((F.col("event_type") == "view").cast("double")).alias("views"))
    out, picked = md.best_mixture(e, ["n", "mean", "views"])
    return out.select("user_id", "cluster", F.lit(picked["k"]).alias("k"))


@register("h10_parameter_log", f"""
    select 'regression' as model, 'slope' as key, {rq('regr_slope(l_extendedprice, l_quantity)', 3)} as value from lineitem
    union all select 'regression', 'intercept', {rq('regr_intercept(l_extendedprice, l_quantity)', 2)} from lineitem
    union all select 'regression', 'n', count(*)::double from lineitem""")
def parameters(spark, sf):
    fit = table(spark, sf, "lineitem").agg(
        F.array(F.struct(F.lit("slope").alias("key"), F.round(F.regr_slope("l_extendedprice", "l_quantity"), 3).alias("value")),
                F.struct(F.lit("intercept").alias("key"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("value")),
                F.struct(F.lit("n").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))).alias("p"))
    return fit.select(F.lit("regression").alias("model"), F.explode("p").alias("p")).select("model", "p.key", "p.value")
