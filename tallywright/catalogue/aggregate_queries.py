"""Aggregations (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.functions import scalars as sc
from tallywright.operators import models as md
from tallywright.operators import shrinkage as sh
from tallywright.plans.assemble import team_stat_rows

ITEMS = "lineitem join part on l_partkey = p_partkey"


def items(spark, sf, *more):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
                                             "l_tax", "l_returnflag", "l_linestatus", "l_extendedprice", *more)
    pa = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    return li.join(pa, F.col("l_partkey") == F.col("p_partkey"))


@register("e1_sum_per_entity", f"""
    select l_suppkey, {rq('sum(l_quantity)', 2)} as quantity, {rq("sum(case when l_partkey % 997 = l_suppkey then l_tax end)", 4)} as rare
    from lineitem group by l_suppkey""")
def sums(spark, sf):
    rare = F.when(F.col("l_partkey") % 997 == F.col("l_suppkey"), F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        r(F.sum("l_quantity"), 2).alias("quantity"), r(F.sum(rare), 4).alias("rare"))


@register("e2_usage", f"""
    select l_partkey, l_suppkey, count(*) as games_played, count(case when l_linenumber = 1 then 1 end) as games_started,
      {rq('sum(l_quantity)', 2)} as minutes from lineitem where l_quantity > 5 group by l_partkey, l_suppkey""")
def usage(spark, sf):
    from tallywright.operators.lineups import usage as use
    rows = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("person_id"), F.col("l_suppkey").alias("team_id"),
        F.when(F.col("l_linenumber") == 1, "G").otherwise("").alias("position"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity")).otherwise(0.0).alias("minutes"))
    return use(rows).select(F.col("player_id").alias("l_partkey"), F.col("team_id").alias("l_suppkey"), "games_played",
                            "games_started", r("minutes", 2).alias("minutes"))


@register("e5_type_histogram", """
    select type, count(*) as count, case when type = 'view' then 'handling' else 'decision' end as class
    from (select event_type as type from events) t group by type""")
def histogram(spark, sf):
    g = table(spark, sf, "events").groupBy(F.col("event_type").alias("type")).agg(F.count(F.lit(1)).alias("count"))
    said = F.when(F.col("type") == "view", "lost ball").otherwise(F.col("type"))
    return g.withColumn("class", sc.turnover_class(said))


@register("e7_overall_totals", f"""
    select count(case when l_returnflag = 'R' then 1 end) as fouls, {rq("sum(case when l_returnflag = 'R' then l_quantity end)", 2)} as points,
      count(case when l_linenumber % 2 = 1 then 1 end) as p3, count(case when l_linenumber % 2 = 0 and l_quantity < 12 then 1 end) as rim
    from lineitem""")
def totals(spark, sf):
    cat = sc.shot_category(F.col("l_linenumber") % 2 + 2, F.col("l_quantity") / 2)
    back = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").agg(
        F.count(F.when(back, 1)).alias("fouls"), r(F.sum(F.when(back, F.col("l_quantity"))), 2).alias("points"),
        F.count(F.when(cat == "P3", 1)).alias("p3"), F.count(F.when(cat == "R", 1)).alias("rim"))


@register("e8_zone_value", f"""
    with s as (select l_returnflag as zone, l_quantity / 2 as dist, case when l_linestatus = 'F' then case when l_linenumber <= 2 then 3.0 else 2.0 end
      else 0.0 end as pts from lineitem)
    select zone, {rq('avg(pts)')} as u, (select {rq('avg(pts)')} from s where dist < 6) as u_rim,
      (select {rq('avg(pts)')} from s where not dist < 6) as u_other from s group by zone""")
def zones(spark, sf):
    from tallywright.plans.profile import zone_values
    s = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("zone"), (F.col("l_quantity") / 2).alias("distance"), (F.col("l_linestatus") == "F").cast("int").alias("made"),
        F.when(F.col("l_linenumber") <= 2, "3PT").otherwise("2PT").alias("shot_type"))
    u, rim, other = zone_values(s)
    return u.select("zone", r("u").alias("u"), r(F.lit(rim)).alias("u_rim"), r(F.lit(other)).alias("u_other"))


@register("e9_cell_expectation", f"""
    with c as (select l_suppkey, l_returnflag as g, l_linenumber as k, count(*)::double as a, sum(case when l_quantity > p_size then 1.0 else 0 end)::double as m
      from {ITEMS} group by all), u as (select g, k, sum(m) / sum(a) as u from c group by g, k)
    select l_suppkey, {rq('(sum(m) - sum(a * u)) / sum(a)')} as d, {rq('sum(a * u * (1 - u)) / (sum(a) * sum(a))', 9)} as s2
    from c join u using (g, k) group by l_suppkey""")
def cells(spark, sf):
    from tallywright.plans.profile import cell_differences
    c = items(spark, sf).groupBy(F.col("l_suppkey").alias("player_id"), F.col("l_returnflag").alias("general_range"),
                                 F.col("l_linenumber").alias("def_dist")).agg(
        F.count(F.lit(1)).cast("double").alias("FG3A"), F.sum(F.when(F.col("l_quantity") > F.col("p_size"), 1.0).otherwise(0.0)).alias("FG3M"))
    return cell_differences(c).select(F.col("player_id").alias("l_suppkey"), r("d").alias("d"), r("s2", 9).alias("s2"))


@register("e10_observed_minus_expected", f"""
    select l_partkey, count(*)::double as n, {rq('(sum(y) - sum(p)) / count(*)')} as d, {rq('sum(p * (1 - p)) / (count(*) * count(*))')} as s2
    from (select l_partkey, case when l_quantity > p_size then 1 else 0 end as y, l_linenumber / 10.0 as p from {ITEMS}) t group by l_partkey""")
def ome(spark, sf):
    s = items(spark, sf).select("l_partkey", (F.col("l_quantity") > F.col("p_size")).cast("int").alias("y"),
                                (F.col("l_linenumber") / 10.0).alias("p"))
    return sh.observed_minus_expected(s, ["l_partkey"], "y", "p").select("l_partkey", "n", r("d").alias("d"), r("s2").alias("s2"))


@register("e11_mean_difference", f"""
    select l_partkey, count(*)::double as n, {rq('avg(v) - any_value(m)')} as d, {rq('any_value(s) / count(*)')} as s2
    from (select l_partkey, l_quantity - p_size as v, avg(l_quantity - p_size) over () as m, var_pop(l_quantity - p_size) over () as s from {ITEMS}) t
    group by l_partkey""")
def mean_diff(spark, sf):
    s = items(spark, sf).select(F.lit("q").alias("stat"), "l_partkey", (F.col("l_quantity") - F.col("p_size")).alias("v"))
    return sh.mean_difference(s, ["stat"], ["l_partkey"], "v").select("l_partkey", "n", r("d").alias("d"), r("s2").alias("s2"))


@register("e12_expected_events", f"""
    with b as (select l_linenumber as c, sum(case when l_returnflag = 'R' then 1.0 else 0 end) / count(*) as rate from lineitem group by all)
    select l_partkey, {rq('sum(rate)')} as expected from lineitem join b on l_linenumber = c group by l_partkey""")
def expected(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag")
    b = li.groupBy("l_linenumber").agg(F.avg((F.col("l_returnflag") == "R").cast("double")).alias("rate"))
    per = li.groupBy("l_partkey", "l_linenumber").agg(F.count(F.lit(1)).alias("a"))
    return per.join(b, "l_linenumber").groupBy("l_partkey").agg(r(F.sum(F.col("a") * F.col("rate"))).alias("expected"))


@register("e13_cost_allocation", f"""
    select l_suppkey, {rq('cost * a3 / a')} as perimeter, {rq('cost * ar / a')} as rim from (select l_suppkey, count(*)::double as a,
      count(case when l_linenumber <= 4 then 1 end) as a3, count(case when l_linenumber >= 6 then 1 end) as ar,
      1.4 * (avg(l_tax) - (select avg(t) from (select avg(l_tax) as t from lineitem group by l_suppkey) x)) * count(*) as cost from lineitem group by l_suppkey) t""")
def cost(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).cast("double").alias("A_Overall"), F.count(F.when(F.col("l_linenumber") <= 2, 1)).alias("A_P3"),
        F.count(F.when(F.col("l_linenumber").isin(3, 4), 1)).alias("A_P2"), F.count(F.when(F.col("l_linenumber") >= 6, 1)).alias("A_R"),
        F.avg("l_tax").alias("phi")).withColumnRenamed("l_suppkey", "player_id")
    from tallywright.plans.profile import contest_shares
    mean = g.agg(F.avg("phi")).first()[0]
    c = 1.4 * (F.col("phi") - F.lit(mean)) * F.col("A_Overall")
    w = g.join(contest_shares(g), "player_id")
    return w.select(F.col("player_id").alias("l_suppkey"), r(c * F.col("perimeter")).alias("perimeter"), r(c * F.col("rim")).alias("rim"))


@register("e14_durability", """
    select l_partkey as player_id, count(*)::double as roster_games, sum(o)::double as games_missed from (select l_partkey, l_suppkey, l_orderkey,
      max(case when l_returnflag = 'A' then 1 when l_quantity <= 5 and l_linenumber > 4 then 1 else 0 end) as o from lineitem
      group by all) t group by l_partkey""")
def durability(spark, sf):
    """Box rows (idle with a reason, or playing) and an inactive list, once per (player, team, game)."""
    from tallywright.plans.assemble import durability_table
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("person_id"),
                                             F.col("l_suppkey").alias("team_id"), "l_quantity", "l_linenumber", "l_returnflag")
    idle = F.col("l_quantity") <= 5
    box = li.withColumn("minutes", F.when(idle, "0:00").otherwise("12:30")).withColumn("comment", F.when(
        idle & (F.col("l_linenumber") > 4), "DNP - Injury").when(idle, "DNP - Coach's Decision").otherwise(""))
    return durability_table(box, li.where("l_returnflag = 'A'"))


@register("e15_pivot", f"""
    select l_suppkey, {', '.join(rq(f"coalesce(sum(l_quantity) filter (l_returnflag = '{f}'), 0)", 2) + f' as "{f}"' for f in 'ANR')}
    from lineitem group by l_suppkey""")
def pivot(spark, sf):
    w = table(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity")).na.fill(0.0)
    return w.select("l_suppkey", *[r(c, 2).alias(c) for c in "ANR"])


@register("e16_unpivot", f"""
    select p_partkey as team_id, 'part.p_retailprice' as stat, {rq('p_retailprice')} as value from part union all
    select p_partkey, 'part.p_size', {rq('p_size')} from part""")
def unpivot(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("TEAM_ID"), "p_name", "p_retailprice", "p_size",
                                        F.col("p_size").alias("PTS_RANK"))
    return team_stat_rows({"part": p}).select("team_id", "stat", r("value").alias("value"))


@register("e17_pooled_variance", f"""
    select {rq('sum((n - 1) * v) / sum(n - 1)', 4)} as pooled, count(*) as n_entities from (select user_id, count(*) as n,
      coalesce(var_samp(value), 0) as v from events group by user_id) t""")
def pooled(spark, sf):
    g = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("v"))
    return g.agg(r(F.sum((F.col("n") - 1) * F.col("v")) / F.sum(F.col("n") - 1), 4).alias("pooled"), F.count(F.lit(1)).alias("n_entities"))


@register("e18_ratio_estimator", f"""
    with m as (select sum(l_quantity) / sum(p_size + 1.0) as mu from {ITEMS})
    select {rq('any_value(mu)')} as mu, {rq('sum((l_quantity - mu * (p_size + 1)) ** 2) / sum(p_size + 1)')} as sigma2 from {ITEMS}, m""")
def ratio(spark, sf):
    s = items(spark, sf).select(F.col("l_quantity").alias("y"), (F.col("p_size") + 1.0).alias("x"))
    mu = s.agg((F.sum("y") / F.sum("x")).alias("mu")).first()["mu"]
    return s.agg(r(F.lit(mu)).alias("mu"), r(F.sum(F.pow(F.col("y") - F.lit(mu) * F.col("x"), F.lit(2))) / F.sum("x")).alias("sigma2"))


@register("e19_entity_variance", f"select user_id, count(*) as n, {rq('var_samp(value)', 4)} as s2 from events group by user_id")
def variance(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), r(F.var_samp("value"), 4).alias("s2"))


@register("e20_conditional_counts", """
    select l_suppkey, count(*) as n, count(case when l_returnflag = 'N' then 1 end) as mid, count(case when l_quantity < 12 then 1 end) as rim
    from lineitem group by l_suppkey""")
def counts(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("mid"), F.count_if(F.col("l_quantity") < 12).alias("rim"))


@register("e21_sum_across_sources", f"""
    select k, {rq('sum(v)', 2)} as total from (select c_nationkey as k, c_acctbal as v from customer union all
      select s_nationkey, s_acctbal from supplier) t group by k""")
def across(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("v"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("v"))
    return c.unionByName(s).groupBy("k").agg(r(F.sum("v"), 2).alias("total"))


@register("e22_ratio_of_sums", f"select l_returnflag, {rq('sum(l_extendedprice) / sum(l_quantity)', 4)} as ppp from lineitem group by l_returnflag")
def ppp(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        r(sc.safe_div(F.sum("l_extendedprice"), F.sum("l_quantity")), 4).alias("ppp"))


@register("e23_linear_imputation", f"""
    with t as (select p_partkey, p_size, case when p_partkey % 5 = 0 then null else p_retailprice + p_size end as y from part),
    f as (select regr_slope(y, p_size) as b, regr_intercept(y, p_size) as a from t)
    select p_partkey, {rq('coalesce(y, a + b * p_size)', 4)} as filled, case when y is null then 1 else 0 end as imputed from t, f""")
def imputation(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice") + F.col("p_size")).alias("y"))
    out, _fit = md.linear_imputation(t, "p_size", "y", "filled", "imputed")
    return out.select("p_partkey", r("filled", 4).alias("filled"), "imputed")


@register("e24_game_table", """
    select l_orderkey as game_id, min(d) as game_date, min(l_suppkey) as home_team_id, max(l_suppkey) as away_team_id,
      cast(max(case when l_suppkey = lo then q end) as int) as home_points, cast(max(case when l_suppkey = hi then q end) as int) as away_points
    from (select l_orderkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as d, l_quantity as q, count(*) over w as n, min(l_suppkey) over w as lo,
      max(l_suppkey) over w as hi from lineitem window w as (partition by l_orderkey)) t where n = 2 and lo < hi group by l_orderkey""")
def games(spark, sf):
    """Orders with exactly two lines of two suppliers, read as games."""
    from tallywright.plans.assemble import game_table
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity")
    two = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_suppkey").alias("home"), F.max("l_suppkey").alias("away")).where(
        "n = 2 and home < away")
    homes = two.select(F.col("l_orderkey").cast("string").alias("game_id"), "home", "away")
    rows = li.join(two.select("l_orderkey"), "l_orderkey", "left_semi").select(
        F.col("l_orderkey").alias("GAME_ID"), F.col("l_suppkey").alias("TEAM_ID"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("GAME_DATE"),
        F.col("l_quantity").alias("PTS"))
    return game_table(rows, homes).withColumn("game_id", F.col("game_id").cast("bigint"))


@register("e25_summary", """
    select count(*) as n_entities, count(distinct c_nationkey) as n_groups, cast(sum(case when c_acctbal < 0 then 1 else 0 end) as bigint) as n_no_data from customer""")
def summary(spark, sf):
    return table(spark, sf, "customer").agg(F.count(F.lit(1)).alias("n_entities"), F.countDistinct("c_nationkey").alias("n_groups"),
                                            F.count_if(F.col("c_acctbal") < 0).alias("n_no_data"))


@register("e26_group_rate_lookup", f"""
    select s_suppkey, {rq('pace')} as pace from supplier join (select c_nationkey, 48 * avg(c_acctbal) / 1000 as pace from customer group by c_nationkey) n
    on s_nationkey = c_nationkey""")
def pace(spark, sf):
    n = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg((48 * F.avg("c_acctbal") / 1000).alias("pace"))
    return table(spark, sf, "supplier").join(n, "s_nationkey").select("s_suppkey", r("pace").alias("pace"))


@register("e27_set_operations", """
    select k, case when a and b then 'both' when a then 'left' else 'right' end as side from (select k, bool_or(src = 'a') as a, bool_or(src = 'b') as b
      from (select o_custkey as k, 'a' as src from orders where o_orderstatus = 'F' union all select o_custkey, 'b' from orders where o_orderstatus = 'P') u
      group by k) t""")
def sets(spark, sf):
    """Union of ids with intersection and symmetric difference read from one grouped pass."""
    o = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "P"))
    a, b = (F.max((F.col("o_orderstatus") == s).cast("int")) for s in ("F", "P"))
    g = o.groupBy(F.col("o_custkey").alias("k")).agg(a.alias("a"), b.alias("b"))
    return g.select("k", F.when((F.col("a") == 1) & (F.col("b") == 1), "both").when(F.col("a") == 1, "left").otherwise("right").alias("side"))


