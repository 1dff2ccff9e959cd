"""Checks and validation (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.catalogue.scalar_queries import ACTIONS, ZONES, pick
from tallywright.functions import scalars as sc
from tallywright.operators import quality as q
from tallywright.operators import ranks
from tallywright.operators import shrinkage as sh

SIDES = """select l_partkey, sum(case when l_returnflag = 'R' and l_linenumber <= 2 then l_quantity else 0 end) as off,
    sum(case when l_returnflag = 'A' and l_linenumber >= 6 then l_quantity else 0 end) as de from lineitem group by l_partkey"""


def sides(spark, sf):
    li = table(spark, sf, "lineitem")
    qty = F.col("l_quantity")
    return li.groupBy("l_partkey").agg(
        F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2), qty).otherwise(0)).alias("off"),
        F.sum(F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") >= 6), qty).otherwise(0)).alias("de"))


@register("c1_population", f"""
    select population, count(*) as n, cast(sum(off + de) as double) as exposure from (select *, case when off > 0 and de > 0 then 'exposed'
      when off > 0 or de > 0 then 'one_sided' else 'none' end as population from ({SIDES}) s) t group by population""")
def population(spark, sf):
    return q.split_population(sides(spark, sf), "off", "de").groupBy("population").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("off") + F.col("de")).alias("exposure"))


@register("c2_first_per_key", f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, {rq('l_quantity')} as quantity from (select *, row_number() over (
      partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_quantity) as rn from lineitem
      where l_linestatus = 'F') t where rn = 1""")
def unique_shots(spark, sf):
    li = table(spark, sf, "lineitem").where("l_linestatus = 'F'").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    one = q.first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    return one.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r("l_quantity").alias("quantity"))


@register("c3_repeated_entity", """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by l_orderkey, l_linenumber having count(*) > 1""")
def repeated(spark, sf):
    return q.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("c4_unknown_label", """
    select c_mktsegment, count(*) as n from customer where c_mktsegment not in ('BUILDING', 'MACHINERY') or c_mktsegment is null
    group by c_mktsegment""")
def labels(spark, sf):
    bad = q.unknown_labels(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])
    return bad.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@register("c5_unclassified_shots", f"""
    select a as action_type, count(*) as n from (select {pick((*ACTIONS, 'Tumbling Shot'), 'l_partkey % 11')} as a,
      {pick(ZONES, 'l_suppkey % 4')} as z from lineitem) t where z in ('Restricted Area', 'In The Paint (Non-RA)')
      and a = 'Tumbling Shot' group by a""")
def unclassified(spark, sf):
    li = table(spark, sf, "lineitem").select(F.expr(pick((*ACTIONS, "Tumbling Shot"), "l_partkey % 11")).alias("a"),
                                             F.expr(pick(ZONES, "l_suppkey % 4")).alias("z"))
    return q.unclassified_shots(li, "a", "z")


@register("c6_proportion_guard", """
    select l_partkey, cast(x as double) as x, cast(n as double) as n from (select l_partkey,
      sum(l_quantity) as x, 26.0 * count(*) as n from lineitem group by l_partkey) t where x > n + 1e-9""")
def proportion_guard(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("x"), (26.0 * F.count(F.lit(1))).alias("n"))
    return sh.proportion_offenders(g)


@register("c7_count_guard", f"""
    select c_nationkey, {rq('sum(c_acctbal - 4500)', 2)} as x, cast(count(*) as double) as n from customer
    group by c_nationkey, c_mktsegment having sum(c_acctbal - 4500) < 0""")
def count_guard(spark, sf):
    g = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum(F.col("c_acctbal") - 4500).alias("x"), F.count(F.lit(1)).cast("double").alias("n"))
    return sh.count_offenders(g).select("c_nationkey", r("x", 2).alias("x"), "n")


@register("c8_two_rows_per_game", """
    select l_orderkey, n_rows, problem from (select s.l_orderkey, n_rows, case when n_rows <> 2 or low = high then 'not two team rows'
      when home is null then 'no box score' when least(home, away) <> low or greatest(home, away) <> high then 'teams differ' end as problem
      from (select l_orderkey, count(*) as n_rows, min(l_suppkey) as low, max(l_suppkey) as high from lineitem group by l_orderkey) s
      left join (select l_orderkey, min(l_suppkey) as home, max(l_partkey % 50) as away from lineitem where l_linenumber < 7
        group by l_orderkey) h on s.l_orderkey = h.l_orderkey) t where problem is not null""")
def game_pairs(spark, sf):
    li = table(spark, sf, "lineitem")
    homes = li.where("l_linenumber < 7").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("home"), F.max(F.col("l_partkey") % 50).alias("away"))
    return q.game_pairs(li.select("l_orderkey", "l_suppkey"), homes, "l_orderkey", "l_suppkey")


CATS = "case when l_linenumber in (1, 2) then 'P3' when l_linenumber in (3, 4) then 'P2ALL' when l_linenumber = 5 then 'R' else 'Overall' end"


@register("c9_contest_checks", f"""
    with per as (select l_suppkey, sum(case when c = 'Overall' then a else 0 end) as o, sum(case when c = 'P3' then a else 0 end) as p3,
        sum(case when c = 'P2ALL' then a else 0 end) as p2, sum(case when c = 'R' then a else 0 end) as rm
        from (select l_suppkey, {CATS} as c, l_quantity as a from lineitem) x group by l_suppkey),
    t as (select sum(o) as o, sum(p3) as p3, sum(p2) as p2, count(case when p2 + 1e-9 < rm then 1 end) as bad from per),
    league as (select sum(o_totalprice) / 2500 as total from orders)
    select 'threes plus twos within 1% of overall' as name, cast(abs(p3 + p2 - o) <= 0.01 * o as int) as ok, cast(p3 + p2 as double) as detail from t
    union all select 'twos at least rim attempts for every entity', cast(bad = 0 as int), cast(bad as double) from t
    union all select 'overall within 1% of league attempts', cast(abs(o - total) <= 0.01 * total as int), cast(o as double) from t, league""")
def contest_checks(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity_id"), F.expr(CATS).alias("category"),
                                               F.col("l_quantity").alias("A"))
    total = table(spark, sf, "orders").agg(F.sum("o_totalprice") / 2500).first()[0]
    return q.contest_checks(rows, float(total or 0))


@register("c10_match_rate", f"""
    select count(*) as n_rows, count(o.k) as n_matched, {rq('count(o.k) / count(*)::double')} as rate,
      cast(count(o.k) / count(*)::double >= 0.99 as int) as ok
    from lineitem l left join (select distinct o_orderkey as k from orders where o_totalprice > 5000) o on l.l_orderkey = o.k""")
def match_rate(spark, sf):
    orders = table(spark, sf, "orders").where("o_totalprice > 5000").select(F.col("o_orderkey").alias("l_orderkey"))
    m = q.match_rate(table(spark, sf, "lineitem"), orders, ["l_orderkey"])
    return m.withColumn("rate", r("rate"))


@register("c11_minutes_agreement", f"""
    select count(*) as n_rows, {rq('avg(abs(coalesce(a.x, 0) - b.y))')} as mean_abs_error,
      count(case when abs(coalesce(a.x, 0) - b.y) > 1 then 1 end) as n_over_one
    from (select user_id, sum(value) / 100 as y from events group by user_id) b left join
      (select user_id, sum(value) / 100 as x from events where event_type <> 'view' group by user_id) a on a.user_id = b.user_id""")
def agreement(spark, sf):
    e = table(spark, sf, "events")
    y = e.groupBy("user_id").agg((F.sum("value") / 100).alias("y"))
    x = e.where("event_type <> 'view'").groupBy("user_id").agg((F.sum("value") / 100).alias("x"))
    m = q.minutes_agreement(y.join(x, "user_id", "left"), "x", "y")
    return m.withColumn("mean_abs_error", r("mean_abs_error"))


@register("c11_unresolved_share", f"""
    select n_events, n_unresolved, {rq('n_unresolved / n_events::double')} as share, cast(n_unresolved / n_events::double <= 0.01 as int) as ok
    from (select count(*) as n_events, cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as n_unresolved from events) t""")
def unresolved(spark, sf):
    per = table(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("event_type") == "error", 1)).alias("lost"))
    return q.unresolved_share(per, "total", "lost").withColumn("share", r("share"))


@register("c12_completeness", """
    with f as (select 'order' as kind, o_orderpriority as name, o_custkey as c, case when o_totalprice > 20000 then 1 else 0 end as p from orders),
    e as (select distinct kind, name from f union all select 'order', '9-NEVER')
    select e.kind, e.name, count(distinct case when p = 1 then c end) as n_with_value, (select count(*) from customer) as n_total,
      cast(count(distinct case when p = 1 then c end) = (select count(*) from customer) as int) as complete
    from e left join (select * from f where c in (select c_custkey from customer)) f on e.kind = f.kind and e.name = f.name group by e.kind, e.name""")
def completeness(spark, sf):
    facts = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("order").alias("kind"),
                                              F.col("o_orderpriority").alias("name"), (F.col("o_totalprice") > 20000).cast("int").alias("present"))
    fields = facts.select("kind", "name").distinct().unionByName(spark.createDataFrame([("order", "9-NEVER")], "kind string, name string"))
    return q.completeness(table(spark, sf, "customer"), facts, fields, "c_custkey")


@register("c12_unknown_fields", "select distinct 'order' as kind, o_orderpriority as name from orders where o_orderpriority > '3'")
def unknown_fields(spark, sf):
    facts = table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderpriority").alias("name"))
    known = spark.createDataFrame([("order", n) for n in ("1-URGENT", "2-HIGH")], "kind string, name string")
    return q.unknown_fields(facts, known)


@register("c13_flag_mismatch", """
    select c.c_custkey, no_data, placeholder_rating from (select c_custkey, case when c_acctbal < 500 then 1 else 0 end as no_data,
      case when c_acctbal < 450 then 1 else 0 end as placeholder_rating from customer) c
    left join (select o_custkey, count(*) as n from orders where o_totalprice > 20000 group by o_custkey) o on c.c_custkey = o.o_custkey
    where no_data <> placeholder_rating or (no_data = 1 and coalesce(n, 0) > 0)""")
def flags(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") < 500).cast("int").alias("no_data"), (F.col("c_acctbal") < 450).cast("int").alias("placeholder_rating"))
    ratings = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(
        F.col("o_totalprice") > 20000, 55.0).otherwise(40.0).alias("rating"))
    return q.flag_mismatch(c, ratings, "c_custkey", 40.0)


@register("c14_range_check", f"""
    select l_orderkey, {rq('l_discount')} as value from lineitem where l_discount is null or l_discount < 0 or l_discount > 0.09""")
def ranges(spark, sf):
    bad = q.out_of_range(table(spark, sf, "lineitem"), ["l_orderkey"], "l_discount", 0.0, 0.09)
    return bad.withColumn("value", r("value"))


@register("c15_failure_list", """
    select * from (select 'tendency' as kind, 'over 26 per line' as name, 'abort' as status, (select count(*) from (select 1 from lineitem
      group by l_partkey having sum(l_quantity) > 26 * count(*) + 1e-9) x) as n_rows
    union all select 'attribute', 'negative balance', 'failed', (select count(*) from customer where c_acctbal < 0)
    union all select 'attribute', 'no size', 'failed', (select count(*) from part where p_size is null)) t where n_rows > 0""")
def failures(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("x"), (26.0 * F.count(F.lit(1))).alias("n"))
    return q.failure_list({
        ("tendency", "over 26 per line"): ("abort", sh.proportion_offenders(g)),
        ("attribute", "negative balance"): ("failed", table(spark, sf, "customer").where("c_acctbal < 0")),
        ("attribute", "no size"): ("failed", table(spark, sf, "part").where("p_size is null"))})


@register("c16_undefined_before_rank", """
    select l_partkey from lineitem group by l_partkey
    having sum(case when l_returnflag = 'R' and l_linenumber = 1 then l_quantity else 0 end) = 0""")
def undefined(spark, sf):
    back = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.col("l_quantity")).otherwise(0)
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(sc.safe_div(F.sum("l_tax"), F.sum(back)).alias("v"))
    return ranks.undefined_values(g, ["l_partkey"], "v")


@register("c17_correlated_pairs", f"""
    with w as (select l_partkey, avg(l_quantity) as qty, sum(l_quantity) as total, count(*)::double as n, avg(l_tax) as tax
      from lineitem group by l_partkey)
    select * from (select 'qty' as a, 'total' as b, {rq('corr(qty, total)')} as r from w union all select 'qty', 'n', {rq('corr(qty, n)')} from w
      union all select 'qty', 'tax', {rq('corr(qty, tax)')} from w union all select 'total', 'n', {rq('corr(total, n)')} from w
      union all select 'total', 'tax', {rq('corr(total, tax)')} from w union all select 'n', 'tax', {rq('corr(n, tax)')} from w) t
    where abs(r) > 0.5""")
def correlated(spark, sf):
    w = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.avg("l_quantity").alias("qty"), F.sum("l_quantity").alias("total"), F.count(F.lit(1)).cast("double").alias("n"), F.avg("l_tax").alias("tax"))
    pairs = q.correlated_pairs(w, ["qty", "total", "n", "tax"], 0.5)
    return pairs.withColumn("r", r("r"))


@register("c18_rebuilt_rate", f"""
    with bucket as (select l_partkey, l_linenumber % 3 as b, count(*) as n, avg(case when l_linestatus = 'F' then 1.0 else 0.0 end) as rate
      from lineitem where l_quantity < 12 group by all),
    rebuilt as (select l_partkey, sum(n * rate) / sum(n) as rebuilt from bucket group by l_partkey),
    whole as (select l_partkey, count(*) as n, avg(case when l_linestatus = 'F' then 1.0 else 0.0 end) as rate from lineitem where l_quantity < 12 group by l_partkey)
    select w.l_partkey, n, {rq('rate')} as rate, {rq('rebuilt')} as rebuilt, {rq('abs(rate - rebuilt)')} as gap from whole w join rebuilt r on r.l_partkey = w.l_partkey""")
def rebuilt(spark, sf):
    g = q.rebuilt_rate_gap(table(spark, sf, "lineitem"), "l_partkey", F.col("l_linenumber") % 3, F.col("l_linestatus") == "F",
                           F.col("l_quantity") < 12)
    return g.select("l_partkey", "n", r("rate").alias("rate"), r("rebuilt").alias("rebuilt"), r("gap").alias("gap"))
