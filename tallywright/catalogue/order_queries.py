"""Ranks, windows and ordered state (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import probit_sql, r, register, rq, table
from tallywright.functions import scalars as sc
from tallywright.operators import models as md
from tallywright.operators import ranks
from tallywright.operators import sequences as sq
from tallywright.operators import shrinkage as sh
from tallywright.operators.ordered import ordered_scan, plan_cuts

ITEMS = "lineitem join part on l_partkey = p_partkey"
COUNTED = f"(select l_partkey, sum(case when l_quantity > p_size then 1 else 0 end)::double as x, count(*)::double as n from {ITEMS} group by l_partkey)"
SHRUNK = f"""(select l_partkey, case when v > 0 then (x + m * t) / (n + t) else m end as value from (select *, m * (1 - m) / nullif(v, 0) - 1 as t
    from {COUNTED} c, (select avg(x / n) as m, var_pop(x / n) - avg(x / n * (1 - x / n) / n) as v from {COUNTED} b) p) q)"""


def successes(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    j = li.join(table(spark, sf, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy(F.lit("rate").alias("stat"), "l_partkey").agg(
        F.sum((F.col("l_quantity") > F.col("p_size")).cast("double")).alias("x"), F.count(F.lit(1)).cast("double").alias("n"))


def shrunk(spark, sf):
    c = successes(spark, sf)
    # rounded, so that values equal by construction tie in every engine
    return sh.shrink_beta(c, sh.fit_beta(c, ["stat"]), ["stat"]).withColumn("value", F.round("value", 10))


RANKED = f"""(select l_partkey, value, (rank() over (order by value) - 1 + 0.5 * count(*) over (partition by value)) / count(*) over () as pct
    from (select l_partkey, round(value, 10) as value from {SHRUNK} s0) s)"""


@register("f1_mid_rank", f"select l_partkey, {rq('pct')} as percentile from {RANKED} t")
def mid_rank(spark, sf):
    return ranks.mid_rank(shrunk(spark, sf), ["stat"], "value").select("l_partkey", r("percentile").alias("percentile"))


@register("f2_normal_score", f"select l_partkey, {rq(probit_sql('pct'))} as z from {RANKED} t")
def normal_score(spark, sf):
    return ranks.normal_score(shrunk(spark, sf), ["stat"], "value").select("l_partkey", r("z").alias("z"))


@register("f3_standard_score", f"""
    select l_returnflag, l_suppkey, {rq('case when s <= 1e-12 * greatest(1.0, abs(m)) then 0 else (v - m) / s end')} as z from (
      select *, avg(v) over w as m, stddev_pop(v) over w as s from (select l_returnflag, l_suppkey, sum(l_quantity) as v from lineitem
        group by all) t window w as (partition by l_returnflag)) u""")
def standard(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.sum("l_quantity").alias("v"))
    return ranks.standard_score(g, ["l_returnflag"], "v").select("l_returnflag", "l_suppkey", r("z").alias("z"))


@register("f4_rating", f"select l_partkey, {rq('value')} as shrunk, {rq('99 * pct')} as rating from {RANKED} t")
def rating(spark, sf):
    """Rate every part: shrunk success rate, mid-rank percentile, 0-99 rating."""
    return ranks.rate_scores(shrunk(spark, sf), ["stat"], "value").select("l_partkey", r("value").alias("shrunk"), r("rating").alias("rating"))


@register("f5_depth_rank", """
    select nation, s_suppkey, cast(case when lead <= 5 then lead else 5 + row_number() over (partition by nation, lead <= 5
      order by avg_q desc, starts desc, s_suppkey) end as int) as depth_rank from (select *, row_number() over (partition by nation
      order by starts desc, avg_q desc, s_suppkey) as lead from (select s_suppkey % 5 as nation, s_suppkey,
        count(case when l_linenumber = 1 then 1 end) as starts, round(avg(l_quantity), 8) as avg_q from supplier join lineitem on s_suppkey = l_suppkey group by all) t) u""")
def depth(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_linenumber") == 1).alias("starts"), F.round(F.avg("l_quantity"), 8).alias("avg_q"))
    s = table(spark, sf, "supplier").join(g, F.col("s_suppkey") == F.col("l_suppkey")).select(
        (F.col("s_suppkey") % 5).alias("nation"), "s_suppkey", "starts", "avg_q")
    return ranks.depth_rank(s, "nation", "s_suppkey", "starts", "avg_q").select("nation", "s_suppkey", "depth_rank")


@register("f6_runs_test", f"""
    with o as (select user_id, ts, event_id, case when event_type = 'purchase' then 1 else 0 end as y from events where event_type in ('purchase', 'error')),
    c as (select *, case when y <> lag(y) over (partition by user_id order by ts, event_id) then 1 else 0 end as ch from o),
    g as (select user_id, count(*) as n, cast(sum(y) as bigint) as n1, cast(1 + sum(ch) as bigint) as runs from c group by user_id),
    m as (select *, 2.0 * n1 * (n - n1) / n + 1 as mu from g)
    select user_id, n, n1, runs, {rq('case when n1 > 0 and n1 < n and (mu - 1) * (mu - 2) > 0 then (runs - mu) / sqrt((mu - 1) * (mu - 2) / (n - 1)) else 0 end')} as z_runs from m""")
def runs(spark, sf):
    e = table(spark, sf, "events").where(F.col("event_type").isin("purchase", "error"))
    t = sq.runs_test(e, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase")
    return t.select("user_id", "n", "n1", "runs", r("z_runs").alias("z_runs"))


def stream(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", F.to_date("ts").alias("d"),
                                             (F.col("user_id") % 2).alias("team"))


@register("f7_next_answer", """
    with s as (select *, last_value(case when event_type = 'error' then event_id when event_type in ('purchase', 'signup') then -1 end ignore nulls) over (
      partition by cast(ts as date) order by ts, event_id rows between unbounded preceding and 1 preceding) as pend from events)
    select event_id, case when pend >= 0 then pend end as asked from s where event_type = 'purchase'""")
def next_answer(spark, sf):
    """The pending error each purchase answers; a signup drops it unanswered."""
    e = stream(spark, sf)
    k = F.col("event_type")
    out = sq.next_answer(e, ["d"], ["ts", "event_id"], k == "error", k == "purchase", k == "signup", F.col("event_id"))
    return out.select("event_id", "asked")


@register("f8_points_until_cleared", f"""
    with s as (select *, last_value(case when event_type = 'signup' then 1 when event_type = 'error' then 0 end ignore nulls) over (partition by user_id
      order by ts, event_id rows between unbounded preceding and 1 preceding) as open from events)
    select user_id, count(*) as n, {rq('sum(value)', 2)} as points from s where event_type = 'purchase' and open = 1 group by user_id""")
def until_cleared(spark, sf):
    """Purchase value credited while a signup is open, until the user's next error closes it."""
    k = F.col("event_type")
    s = sq.carry(stream(spark, sf), ["user_id"], ["ts", "event_id"], {"open": F.when(k == "signup", 1).when(k == "error", 0)})
    return s.where((k == "purchase") & (F.col("open") == 1)).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 2).alias("points"))


@register("f9_state_before", """
    select event_id, last_value(case event_type when 'purchase' then 1 - user_id % 2 when 'error' then user_id % 2 when 'signup' then user_id % 2 end
      ignore nulls) over (partition by cast(ts as date) order by ts, event_id rows between unbounded preceding and 1 preceding) as holder from events""")
def state_before(spark, sf):
    """Side in possession before each event: makes pass it over, misses and gains keep it."""
    k = F.col("event_type")
    sig = F.when(k == "purchase", 1 - F.col("team")).when(k.isin("error", "signup"), F.col("team"))
    return sq.carry(stream(spark, sf), ["d"], ["ts", "event_id"], {"holder": sig}).select("event_id", "holder")


@register("f10_rebound_side", """
    with s as (select *, last_value(case event_type when 'error' then user_id % 2 when 'purchase' then -1 when 'click' then -1 end ignore nulls) over (
      partition by cast(ts as date) order by ts, event_id rows between unbounded preceding and 1 preceding) as miss from events)
    select user_id, count(case when miss = user_id % 2 then 1 end) as own, count(case when miss >= 0 and miss <> user_id % 2 then 1 end) as other
    from s where event_type = 'click' group by user_id""")
def rebounds(spark, sf):
    """A click after a miss is an own or an opposing rebound; makes and clicks clear the miss."""
    k = F.col("event_type")
    s = sq.carry(stream(spark, sf), ["d"], ["ts", "event_id"], {"miss": F.when(k == "error", F.col("team")).when(
        k.isin("purchase", "click"), F.lit(-1).cast("bigint"))})
    m = F.col("miss")
    return s.where(k == "click").groupBy("user_id").agg(
        F.count(F.when(m == F.col("team"), 1)).alias("own"), F.count(F.when((m >= 0) & (m != F.col("team")), 1)).alias("other"))


@register("f11_segments", f"""
    with s as (select *, sum(case when event_type = 'signup' then 1 else 0 end) over (partition by cast(ts as date) order by ts, event_id
      rows between unbounded preceding and current row) as seg from events)
    select cast(ts as date) as d, cast(seg as bigint) as segment, count(*) as n, {rq('sum(value)', 2)} as value from s group by 1, 2""")
def segments(spark, sf):
    s = sq.split_at_changes(stream(spark, sf), ["d"], ["ts", "event_id"], F.col("event_type") == "signup")
    return s.groupBy("d", "segment").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 2).alias("value"))


SESSIONS = """(select user_id, (coalesce(nxt, epoch_us(cast(cast(ts as date) as timestamp)) + 86400000000) - start_at) / 6e7 as minutes from (
    select user_id, ts, event_type, epoch_us(ts) as start_at, lead(epoch_us(ts)) over (partition by user_id, cast(ts as date) order by ts, event_id) as nxt
    from events where event_type in ('signup', 'error')) m where event_type = 'signup')"""


def stretches(spark, sf):
    e = stream(spark, sf).withColumn("at", sc.micros("ts"))
    close = (F.unix_date("d").cast("bigint") + 1) * 86_400_000_000
    i = sq.marks_to_intervals(e, ["user_id", "d"], ["at", "event_id"], "at", F.col("event_type") == "signup", F.col("event_type") == "error", close)
    return i.select("user_id", ((F.col("end_at") - F.col("start_at")) / 6e7).alias("minutes"))


@register("f12_stretch_lengths", f"select user_id, count(*) as n, {rq('avg(minutes)', 4)} as mean, {rq('var_samp(minutes)', 2)} as s2 from {SESSIONS} s group by user_id")
def stretch_lengths(spark, sf):
    return stretches(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), r(F.avg("minutes"), 4).alias("mean"),
                                                       r(F.var_samp("minutes"), 2).alias("s2"))


@register("f13_time_active", f"select user_id, {rq('sum(minutes) * 60', 3)} as seconds from {SESSIONS} s group by user_id")
def time_active(spark, sf):
    return stretches(spark, sf).groupBy("user_id").agg(r(F.sum("minutes") * 60, 3).alias("seconds"))


@register("f16_merge_consecutive", """
    with p as (select *, lag(event_type) over w as pt, lag(user_id % 2) over w as ps, lag(hour(ts)) over w as ph from events
      window w as (partition by cast(ts as date) order by ts, event_id)),
    h as (select *, sum(case when event_type = pt and user_id % 2 = ps and hour(ts) = ph then 0 else 1 end) over (partition by cast(ts as date)
      order by ts, event_id rows between unbounded preceding and current row) as g from p)
    select min(event_id) as event_id, cast(ts as date) as d, count(*) as n, string_agg(user_id::varchar, ',' order by ts, event_id) as users
    from h group by cast(ts as date), g""")
def merge_consecutive(spark, sf):
    """Neighbouring rows of one kind, side and hour become one row listing their users in order."""
    e = stream(spark, sf).withColumn("h", F.hour("ts"))
    cuts = plan_cuts(e, ["d"], "ts")
    kind = F.struct("event_type", "team", "h")
    e = ordered_scan(e, ["d"], ["ts", "event_id"], {"p": ("previous", kind)}, cuts)
    same = (F.col("p.event_type") == F.col("event_type")) & (F.col("p.team") == F.col("team")) & (F.col("p.h") == F.col("h"))
    g = ordered_scan(e, ["d"], ["ts", "event_id"], {"g": ("sum", F.when(same, 0).otherwise(1))}, cuts)
    rows = F.array_sort(F.collect_list(F.struct("ts", "event_id", "user_id")))
    return g.groupBy("d", "g").agg(F.min("event_id").alias("event_id"), F.count(F.lit(1)).alias("n"), F.array_join(
        F.transform(rows, lambda x: x["user_id"].cast("string")), ",").alias("users")).drop("g")


@register("f17_back_fill", """
    with c as (select *, sum(case when event_type = 'error' then 1 else 0 end) over (partition by cast(ts as date) order by ts, event_id
      rows between unbounded preceding and current row) as shot from events),
    f as (select cast(ts as date) as d, shot, arg_min(user_id, (ts, event_id)) as helper from c where event_type = 'view' and value > 150 group by 1, 2)
    select c.event_id, f.helper from c left join f on f.d = cast(c.ts as date) and f.shot = c.shot where c.event_type = 'error'""")
def back_fill(spark, sf):
    """Each error takes the first large view after it, before the next error."""
    k = F.col("event_type")
    c = sq.split_at_changes(stream(spark, sf), ["d"], ["ts", "event_id"], k == "error", "shot")
    big = F.when((k == "view") & (F.col("value") > 150), F.struct("ts", "event_id"))
    g = c.where("shot > 0").groupBy("d", "shot").agg(F.min(F.when(k == "error", F.col("event_id"))).alias("event_id"),
                                                     F.min_by("user_id", big).alias("helper"))
    return g.select("event_id", "helper")


@register("f18_group_folds", """
    select l_orderkey, cast((dense_rank() over (order by cast(l_orderkey as varchar)) - 1) % 5 as int) as fold from (select distinct l_orderkey from lineitem) t""")
def group_folds(spark, sf):
    return md.group_folds(table(spark, sf, "lineitem").select("l_orderkey").distinct(), "l_orderkey").select("l_orderkey", "fold")


@register("f19_row_folds", "select p_partkey, cast((row_number() over (order by p_retailprice, p_partkey) - 1) % 5 as int) as fold from part")
def row_folds(spark, sf):
    return md.row_folds(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"]).select("p_partkey", "fold")
