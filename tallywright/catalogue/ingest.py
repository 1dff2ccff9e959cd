"""Ingest operators (A): payloads are rebuilt as JSON from table rows, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.functions.scalars import to_num
from tallywright.operators.quality import failure_list, orphans, out_of_range
from tallywright.sources import payloads as pl


def text(c):
    return F.col(c).cast("string")


@register("a1_result_set_table", f"""
    select event_id, event_type, {rq('value')} as value from events where event_id % 3 <> 2
    union all select event_id, event_type, {rq('value')} from events where event_id % 3 = 2""")
def result_set_table(spark, sf):
    """List, single-object and ``resultSet`` payloads, one per event."""
    one = F.struct(F.lit("Events").alias("name"), F.array(*map(F.lit, ("VALUE", "EVENT_ID", "TYPE"))).alias("headers"),
                   F.array(F.array(text("value"), text("event_id"), F.col("event_type"))).alias("rowSet"))
    kind = F.col("event_id") % 3
    payload = (F.when(kind == 0, F.to_json(F.struct(F.array(one).alias("resultSets"))))
               .when(kind == 1, F.to_json(F.struct(one.alias("resultSets"))))
               .otherwise(F.to_json(F.struct(one.alias("resultSet")))))
    rows = pl.result_set_rows(table(spark, sf, "events").select(payload.alias("payload")), "payload")
    t = pl.result_set_table(rows, "Events", ["EVENT_ID", "TYPE", "VALUE"])
    return t.select(F.col("EVENT_ID").cast("bigint").alias("event_id"), F.col("TYPE").alias("event_type"),
                    r(to_num("VALUE")).alias("value"))


@register("a2_two_level_header", f"""
    select p_partkey, {rq('p_size')} as "size_x1", {rq('p_size * 2')} as "size_x2",
           {rq('p_retailprice')} as "price_x1", {rq('p_retailprice * 2', 4)} as "price_x2" from part""")
def two_level_header(spark, sf):
    zone = F.struct(F.lit(1).alias("columnsToSkip"), F.lit(2).alias("columnSpan"),
                    F.array(F.lit("Size"), F.lit("Price")).alias("columnNames"))
    cols = F.struct(F.lit(0).alias("columnsToSkip"), F.lit(1).alias("columnSpan"),
                    F.array(*map(F.lit, ("KEY", "X1", "X2", "X1", "X2"))).alias("columnNames"))
    row = F.array(text("p_partkey"), text("p_size"), (F.col("p_size") * 2).cast("string"), text("p_retailprice"),
                  (F.col("p_retailprice") * 2).cast("string"))
    body = F.to_json(F.struct(F.struct(F.array(zone, cols).alias("headers"), F.array(row).alias("rowSet")).alias("resultSets")))
    rows = pl.two_level_names(table(spark, sf, "part").select(body.alias("payload")), "payload")
    t = pl.two_level_table(rows, ["KEY", "Size|X1", "Size|X2", "Price|X1", "Price|X2"])
    return t.select(F.col("KEY").cast("bigint").alias("p_partkey"), r(to_num("`Size|X1`")).alias("size_x1"),
                    r(to_num("`Size|X2`")).alias("size_x2"), r(to_num("`Price|X1`")).alias("price_x1"),
                    r(to_num("`Price|X2`"), 4).alias("price_x2"))


@register("a3_required_columns", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def required_columns(spark, sf):
    df = pl.require_columns(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("a4_action_list", f"""
    select event_id as "actionNumber", event_type as "actionType", {rq('value')} as value, 0 as ord from events
    union all select event_id, 'echo', null, 1 from events where event_type = 'error'""")
def action_list(spark, sf):
    """Actions with ragged keys, in both list shapes."""
    first = F.struct(F.col("event_id").alias("actionNumber"), F.col("event_type").alias("actionType"), F.col("value"))
    echo = F.struct(F.col("event_id").alias("actionNumber"), F.lit("echo").alias("actionType"), F.lit(None).cast("double").alias("value"))
    both = F.when(F.col("event_type") == "error", F.array(first, echo)).otherwise(F.array(first))
    body = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.struct(both.alias("actions")).alias("game")))).otherwise(
        F.to_json(F.struct(both.alias("actions"))))
    acts = pl.read_actions(table(spark, sf, "events").select(body.alias("payload")), "payload",
                           {"actionNumber": "bigint", "actionType": "string", "value": "double"})
    return acts.select("actionNumber", "actionType", r("value").alias("value"), "ord")


@register("a5_union_tagged", f"""
    select l_returnflag as source, count(*) as n, {rq('sum(l_quantity)', 2)} as quantity
    from lineitem group by l_returnflag""")
def union_tagged(spark, sf):
    df = table(spark, sf, "lineitem")
    frames = {k: df.where(F.col("l_returnflag") == k).select("l_quantity") for k in ("A", "N", "R")}
    return pl.union_tagged(frames, "source").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("quantity"))


@register("a6_prefer_source", """
    with p as (select l_orderkey from lineitem where l_linestatus = 'F'),
    b as (select l_orderkey from lineitem where l_orderkey not in (select l_orderkey from p))
    select l_orderkey, 'primary' as origin, count(*) as n from p group by l_orderkey
    union all select l_orderkey, 'backup', count(*) from b group by l_orderkey""")
def prefer_source(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus")
    out = pl.prefer_source(df.where("l_linestatus = 'F'"), df, ["l_orderkey"])
    return out.groupBy("l_orderkey", "origin").agg(F.count(F.lit(1)).alias("n"))


@register("a7_pick_columns", f"select p_brand, {rq('sum(p_retailprice)', 2)} as amount, "
          f"{rq('sum(p_size)')} as units from part group by p_brand")
def pick_columns(spark, sf):
    df = pl.pick_columns(table(spark, sf, "part"), "part", [("p_units", "p_cost"), ("p_size", "p_retailprice")],
                         ("units", "amount"))
    return df.groupBy("p_brand").agg(r(F.sum("amount"), 2).alias("amount"), r(F.sum("units")).alias("units"))


@register("a8_optional_source", """
    select c.c_custkey, coalesce(o.n, 0) as n_orders, 0 as n_returns from customer c left join
    (select o_custkey, count(*) as n from orders group by o_custkey) o on c.c_custkey = o.o_custkey""")
def optional_source(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    there = pl.optional_source(c, orders, ["c_custkey"], {"n_orders": 0})
    gone = pl.optional_source(there, None, ["c_custkey"], {"n_returns": 0})
    return gone.select("c_custkey", F.col("n_orders").cast("bigint").alias("n_orders"), "n_returns")


@register("a9_lenient_number", """
    select o_orderkey, try_cast(trim(split_part(o_orderpriority, '-', 1)) as double) as level,
           try_cast(trim(o_orderpriority) as double) as whole from orders""")
def lenient_number(spark, sf):
    df = table(spark, sf, "orders")
    return df.select("o_orderkey", to_num(F.split("o_orderpriority", "-")[0]).alias("level"),
                     to_num("o_orderpriority").alias("whole"))


@register("a10_publish_gate", """
    select * from (
      select 'key' as kind, 'lineitem order' as name, 'failed' as status,
        (select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)) as n_rows
      union all select 'range', 'discount', 'failed',
        (select count(*) from lineitem where l_discount < 0 or l_discount > 0.08 or l_discount is null)
      union all select 'range', 'quantity', 'failed',
        (select count(*) from lineitem where l_quantity < 1 or l_quantity > 50 or l_quantity is null)) t
    where n_rows > 0""")
def publish_gate(spark, sf):
    """The failure list a publish reads first; a row here stops it."""
    li = table(spark, sf, "lineitem")
    return failure_list({
        ("key", "lineitem order"): ("failed", orphans(li, table(spark, sf, "orders"), "l_orderkey", "o_orderkey")),
        ("range", "discount"): ("failed", out_of_range(li, ["l_orderkey"], "l_discount", 0.0, 0.08)),
        ("range", "quantity"): ("failed", out_of_range(li, ["l_orderkey"], "l_quantity", 1.0, 50.0))})
