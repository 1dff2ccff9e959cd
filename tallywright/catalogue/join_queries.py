"""Joins (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.functions.scalars import micros
from tallywright.operators import sequences as sq
from tallywright.plans.profile import union_all


@register("d1_count_tables", f"""
    select k.user_id, coalesce(a.n, 0) as n_clicks, coalesce(b.v, 0) as purchase_value, coalesce(c.m, 0) as max_error
    from (select distinct user_id from events where event_type in ('click', 'purchase', 'error')) k
    left join (select user_id, count(*)::double as n from events where event_type = 'click' group by user_id) a on a.user_id = k.user_id
    left join (select user_id, {rq('sum(value)', 4)} as v from events where event_type = 'purchase' group by user_id) b on b.user_id = k.user_id
    left join (select user_id, {rq('max(value)', 4)} as m from events where event_type = 'error' group by user_id) c on c.user_id = k.user_id""")
def count_tables(spark, sf):
    """Three sources on one entity: united in long form, pivoted once, gaps 0."""
    e = table(spark, sf, "events")

    def source(kind, stat, agg):
        return e.where(F.col("event_type") == kind).groupBy("user_id").agg(agg.cast("double").alias("value")).withColumn("stat", F.lit(stat))

    long = union_all([source("click", "n_clicks", F.count(F.lit(1))), source("purchase", "purchase_value", F.sum("value")),
                      source("error", "max_error", F.max("value"))])
    w = long.groupBy("user_id").pivot("stat", ["n_clicks", "purchase_value", "max_error"]).agg(F.sum("value")).na.fill(0.0)
    return w.select("user_id", "n_clicks", r("purchase_value", 4).alias("purchase_value"), r("max_error", 4).alias("max_error"))


@register("d2_inner_join", f"""
    select o_custkey, count(*) as n, {rq('sum(l_quantity)', 2)} as quantity from orders join lineitem on o_orderkey = l_orderkey
    group by o_custkey""")
def inner(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("quantity"))


@register("d3_left_join_indicator", """
    select o_orderkey, case when k is null then 0 else 1 end as matched from orders left join
    (select distinct l_orderkey as k from lineitem where l_returnflag = 'R') l on o_orderkey = k""")
def indicator(spark, sf):
    li = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").select("o_orderkey").join(li.withColumn("hit", F.lit(1)), "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("hit", F.lit(0)).alias("matched"))


@register("d4_rate_lookup", f"""
    with u as (select l_returnflag, l_linenumber, avg(l_quantity) as u from lineitem group by all)
    select l_suppkey, {rq('sum(u)', 4)} as expected from lineitem join u using (l_returnflag, l_linenumber) group by l_suppkey""")
def lookup(spark, sf):
    cell = ["l_returnflag", "l_linenumber"]
    per = table(spark, sf, "lineitem").groupBy("l_suppkey", *cell).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    u = per.groupBy(*cell).agg((F.sum("q") / F.sum("n")).alias("u"))
    return per.join(u, cell).groupBy("l_suppkey").agg(r(F.sum(F.col("n") * F.col("u")), 4).alias("expected"))


# a session runs from a signup to the next error of the same user and day, else to the day's end
SESSIONS = """(select user_id, d, start_at, coalesce(end_at, (epoch_us(d::timestamp) + 86400000000)) as end_at from (
    select user_id, cast(ts as date) as d, event_type, epoch_us(ts) as start_at, lead(epoch_us(ts)) over (
      partition by user_id, cast(ts as date) order by ts, event_id) as end_at from events where event_type in ('signup', 'error')) m
    where event_type = 'signup')"""


def marked(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("d"),
                                             micros("ts").alias("at"))


def sessions(spark, sf):
    e = marked(spark, sf)
    close = (F.unix_date("d").cast("bigint") + 1) * 86_400_000_000
    return sq.marks_to_intervals(e, ["user_id", "d"], ["at", "event_id"], "at", F.col("event_type") == "signup",
                                 F.col("event_type") == "error", close).select("user_id", "d", "start_at", "end_at")


@register("d5_interval_join", f"""
    select e.user_id % 2 as team, i.user_id as player, count(*) as n, {rq('sum(e.value)', 3)} as value
    from (select *, epoch_us(ts) as at, cast(ts as date) as d from events where event_type in ('view', 'click', 'purchase')) e
    join {SESSIONS} i on e.d = i.d and e.user_id % 2 = i.user_id % 2 and e.at >= i.start_at and e.at < i.end_at group by all""")
def interval(spark, sf):
    """Every event credited to each open session of its side."""
    e = marked(spark, sf).where(F.col("event_type").isin("view", "click", "purchase")).select(
        (F.col("user_id") % 2).alias("team"), "d", "at", "value")
    i = sessions(spark, sf).select((F.col("user_id") % 2).alias("team"), F.col("user_id").alias("player"), "d", "start_at", "end_at")
    sums = sq.sums_within(e, i, ["d", "team"], "at", "start_at", "end_at", {"n": F.lit(1).cast("bigint"), "value": F.col("value")}, ["player"])
    return sums.groupBy("team", "player").agg(F.sum("n").alias("n"), r(F.sum("value"), 3).alias("value")).where("n > 0")


@register("d6_point_in_own_interval", f"""
    select e.event_id, {rq('(e.at - i.start_at) / 6e7', 5)} as minutes_on
    from (select *, epoch_us(ts) as at, cast(ts as date) as d from events where event_type = 'purchase') e
    join {SESSIONS} i on e.d = i.d and e.user_id = i.user_id and e.at >= i.start_at and e.at < i.end_at""")
def minutes_on(spark, sf):
    e = marked(spark, sf).where("event_type = 'purchase'").select("event_id", "user_id", "d", "at")
    hit = sq.interval_join(e, sessions(spark, sf), ["user_id", "d"], "at", "start_at", "end_at", 21_600_000_000.0)
    return hit.select("event_id", r((F.col("at") - F.col("start_at")) / 6e7, 5).alias("minutes_on"))


@register("d7_semi_and_anti", """
    select c_custkey, 'with' as side from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')
    union all select c_custkey, 'without' from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""")
def semi_anti(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").withColumn("side", F.lit("with")).unionByName(
        c.join(o, "c_custkey", "left_anti").withColumn("side", F.lit("without")))


@register("d8_fill_from_second", f"""
    select c_custkey, {rq('coalesce(case when c_acctbal > 1000 then c_acctbal end, o.m)', 2)} as amount from customer left join
    (select o_custkey, max(o_totalprice) as m from orders group by o_custkey) o on c_custkey = o_custkey""")
def fill(spark, sf):
    own = F.when(F.col("c_acctbal") > 1000, F.col("c_acctbal"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("m"))
    return table(spark, sf, "customer").join(o, "c_custkey", "left").select("c_custkey", r(F.coalesce(own, "m"), 2).alias("amount"))


@register("d9_latest_per_column", f"""
    select user_id, {rq("arg_max(value, (ts, event_id)) filter (event_type = 'click')")} as click,
      {rq("arg_max(value, (ts, event_id)) filter (event_type = 'purchase')")} as purchase,
      {rq("arg_max(value, (ts, event_id)) filter (event_type = 'signup' and value > 80)")} as big_signup from events group by user_id""")
def latest(spark, sf):
    e = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", *[F.when(c, F.col("value")).alias(n) for n, c in (
            ("click", F.col("event_type") == "click"), ("purchase", F.col("event_type") == "purchase"),
            ("big_signup", (F.col("event_type") == "signup") & (F.col("value") > 80)))])
    w = sq.latest_per_column(e, "user_id", ["ts", "event_id"], ["click", "purchase", "big_signup"])
    return w.select("user_id", *[r(c).alias(c) for c in ("click", "purchase", "big_signup")])


NAMES = "'n' || (user_id % 40)"
SHARED = f"""with m as (select cast(ts as date) as d, event_id, user_id, {NAMES} as name, event_type from events),
    pool as (select d, name, count(distinct user_id) as k, min(user_id) as only_id from m where event_type <> 'error' group by d, name),
    ask as (select * from m where event_type = 'error')"""


@register("d10_resolve_names", f"""
    {SHARED}, follow as (select a.event_id, arg_min(m.user_id, m.event_id) as nxt from ask a join pool p on a.d = p.d and a.name = p.name
        and p.k > 1 join m on m.d = a.d and m.name = a.name and m.event_type <> 'error' and m.event_id > a.event_id group by a.event_id)
    select a.event_id, case when p.k = 1 then p.only_id else f.nxt end as resolved from ask a
    left join pool p on a.d = p.d and a.name = p.name left join follow f on f.event_id = a.event_id""")
def names(spark, sf):
    """A name spoken in an error row, resolved among the day's users; shared names go to who acts next."""
    m = table(spark, sf, "events").select(F.to_date("ts").alias("d"), F.col("event_id").alias("ord"), "user_id", F.concat(
        F.lit("n"), (F.col("user_id") % 40).cast("string")).alias("name"), "event_type")
    acts = m.where("event_type <> 'error'")
    out = sq.resolve_names(m.where("event_type = 'error'").select("d", "ord", "name"), acts.select("d", "name", "user_id"),
                           ["d"], "name", "user_id", later=acts.select("d", "user_id", "ord"))
    return out.select(F.col("ord").alias("event_id"), "resolved")


@register("d11_category_difference", f"""
    select l_suppkey, {rq("sum(case when l_linenumber <= 4 then l_quantity else 0 end) - sum(case when l_linenumber = 7 then l_quantity else 0 end)", 2)} as p2
    from lineitem where l_linenumber <= 4 or l_linenumber = 7 group by l_suppkey""")
def difference(spark, sf):
    n, qty = F.col("l_linenumber"), F.col("l_quantity")
    used = table(spark, sf, "lineitem").where((n <= 4) | (n == 7))
    return used.groupBy("l_suppkey").agg(r(F.sum(F.when(n <= 4, qty).otherwise(-qty)), 2).alias("p2"))


@register("d12_name_among_others", f"""
    with m as (select cast(ts as date) as d, event_id, user_id, {NAMES} as name, event_type from events),
    others as (select p.event_id, min(q.user_id) as lo, max(q.user_id) as hi from m p join (select distinct d, name, user_id from m) q
      on p.d = q.d and p.name = q.name and q.user_id <> p.user_id where p.event_type = 'purchase' group by p.event_id)
    select event_id, case when lo = hi then lo end as helper from others""")
def others(spark, sf):
    """The only other user of the day under the same name (own row excluded)."""
    m = table(spark, sf, "events").select(F.to_date("ts").alias("d"), "event_id", "user_id", F.concat(
        F.lit("n"), (F.col("user_id") % 40).cast("string")).alias("name"), "event_type")
    pool = m.select("d", "name", "user_id").distinct().groupBy("d", "name").agg(
        F.count(F.lit(1)).alias("k"), F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    mine = m.where("event_type = 'purchase'").join(pool.where("k > 1"), ["d", "name"])
    rest = F.when(F.col("user_id") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    return mine.select("event_id", F.when(F.col("k") == 2, rest).alias("helper"))


@register("d13_explode_and_join", f"""
    with st as (select o_orderkey, unnest([o_orderkey, o_orderkey + 1, o_orderkey + 2]) as shot from orders)
    select st.o_orderkey, {rq('coalesce(sum(l.q), 0)', 2)} as quantity, count(l.k) as hits from st left join
    (select l_orderkey as k, sum(l_quantity) as q from lineitem group by l_orderkey) l on st.shot = l.k group by st.o_orderkey""")
def explode_join(spark, sf):
    k = F.col("o_orderkey")
    st = table(spark, sf, "orders").select("o_orderkey", F.explode_outer(F.array(k, k + 1, k + 2)).alias("l_orderkey"))
    per = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    return st.join(per, "l_orderkey", "left").groupBy("o_orderkey").agg(
        r(F.coalesce(F.sum("q"), F.lit(0.0)), 2).alias("quantity"), F.count("q").alias("hits"))


@register("d14_entity_breakdown", f"""
    select p_partkey, p_name, coalesce(n, 0) as n_lines, {rq('coalesce(qty, 0)', 2)} as quantity, coalesce(n_supp, 0) as n_suppliers
    from part left join (select l_partkey, count(*) as n, sum(l_quantity) as qty, count(distinct l_suppkey) as n_supp from lineitem
      group by l_partkey) l on p_partkey = l_partkey where lower(p_name) like '%widget%' or p_partkey = 77""")
def breakdown(spark, sf):
    """Everything known about entities whose folded name holds a fragment, or one id."""
    from tallywright.functions.scalars import norm_name
    hit = norm_name("p_name", keep_spaces=True).contains("widget") | (F.col("p_partkey") == 77)
    who = table(spark, sf, "part").where(hit).select("p_partkey", "p_name")
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_suppkey")
    facts = li.join(who.select("p_partkey"), "p_partkey", "left_semi").groupBy("p_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"), F.countDistinct("l_suppkey").alias("s"))
    return who.join(facts, "p_partkey", "left").select(
        "p_partkey", "p_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_lines"),
        r(F.coalesce("qty", F.lit(0.0)), 2).alias("quantity"), F.coalesce("s", F.lit(0)).cast("bigint").alias("n_suppliers"))
