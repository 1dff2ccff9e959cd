"""Scalar rules (B) on texts and numbers built from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.functions import scalars as sc


def pick(words, index):
    """SQL CASE choosing a word by an index expression; valid in both engines."""
    cases = " ".join(f"when {i} then '{w}'" for i, w in enumerate(words))
    return f"case {index} {cases} end"


@register("b1_safe_div", f"""
    select l_partkey, {rq("sum(l_tax) / nullif(sum(case when l_returnflag = 'R' and l_linenumber = 1 then l_quantity else 0 end), 0)")} as ratio
    from lineitem group by l_partkey""")
def safe_div(spark, sf):
    back = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.col("l_quantity")).otherwise(0)
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_tax").alias("t"), F.sum(back).alias("q"))
    return g.select("l_partkey", r(sc.safe_div("t", "q")).alias("ratio"))


@register("b2_height_inches", """
    select p_partkey, case when p_size % 7 = 0 then null when p_size % 11 = 0 then null
        else cast(p_size // 12 + 5 as double) * 12 + p_size % 12 end as inches from part""")
def height(spark, sf):
    feet = F.floor(F.col("p_size") / 12) + 5
    text = F.when(F.col("p_size") % 7 == 0, feet.cast("string")).when(F.col("p_size") % 11 == 0, F.lit("a-b")).otherwise(
        F.concat_ws("-", feet.cast("string"), (F.col("p_size") % 12).cast("string")))
    return table(spark, sf, "part").select("p_partkey", sc.height_inches(text).alias("inches"))


@register("b3_minutes_value", f"""
    select form, count(*) as n, {rq('sum(m)', 4)} as minutes from (
      select l_linenumber % 5 as form, case l_linenumber % 5 when 0 then l_quantity + (l_orderkey % 60) / 60.0
        when 1 then l_quantity + (l_orderkey % 60) / 60.0 when 2 then l_quantity else 0 end as m from lineitem) t
    group by form""")
def minutes(spark, sf):
    whole, sec = F.col("l_quantity").cast("int").cast("string"), F.col("l_orderkey") % 60
    form = F.col("l_linenumber") % 5
    text = (F.when(form == 0, F.concat(whole, F.lit(":"), F.lpad(sec.cast("string"), 2, "0")))
            .when(form == 1, F.concat(F.lit("PT"), whole, F.lit("M"), F.format_string("%02d.00S", sec)))
            .when(form == 2, F.col("l_quantity").cast("string")).when(form == 3, F.lit("")))
    df = table(spark, sf, "lineitem").select(form.alias("form"), sc.minutes_value(text).alias("m"))
    return df.groupBy("form").agg(F.count(F.lit(1)).alias("n"), r(F.sum("m"), 4).alias("minutes"))


PERIOD = "cast(hour(ts) // 4 + 1 as int)"


@register("b4_period_bounds", f"""
    select p as period, count(*) as n,
      cast(case when p <= 4 then (p - 1) * 7200 else 28800 + (p - 5) * 3000 end as int) as period_start,
      cast(case when p <= 4 then p * 7200 else 28800 + (p - 4) * 3000 end as int) as period_end
    from (select {PERIOD} as p from events) e group by p""")
def periods(spark, sf):
    p = (F.floor(F.hour("ts") / 4) + 1).cast("int").alias("period")
    g = table(spark, sf, "events").groupBy(p).agg(F.count(F.lit(1)).alias("n"))
    return g.select("period", "n", sc.period_start("period").alias("period_start"), sc.period_end("period").alias("period_end"))


@register("b5_clock_tenths", f"""
    select event_id, cast(case when p <= 4 then p * 7200 else 28800 + (p - 4) * 3000 end - (mm * 60 + ss) * 10 - tt as int) as t
    from (select event_id, {PERIOD} as p, cast(minute(ts) // 6 as int) as mm, cast(second(ts) as int) as ss,
                 cast(event_id % 10 as int) as tt from events) e""")
def clock(spark, sf):
    text = F.concat(F.lit("PT"), F.floor(F.minute("ts") / 6).cast("string"), F.lit("M"), F.second("ts").cast("string"),
                    F.lit("."), (F.col("event_id") % 10).cast("string"), F.lit("0S"))
    p = (F.floor(F.hour("ts") / 4) + 1).cast("int")
    return table(spark, sf, "events").select("event_id", sc.clock_tenths(text, p).alias("t"))


@register("b6_norm_name", """
    select doc_id, md5(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g')) as folded from documents""")
def names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(sc.norm_name("text")).alias("folded"))


LABELS = ("G", "G-F", "F-G", "F", "F-C", "C-F", "C")


@register("b7_position_index", f"""
    select c_custkey, cast(case {pick(LABELS, 'c_nationkey % 7')} when 'G' then 1 when 'G-F' then 2 when 'F-G' then 2
      when 'F' then 3 when 'F-C' then 4 when 'C-F' then 4 else 5 end as int) as position_index from customer""")
def position(spark, sf):
    label = F.concat(F.lit(" "), F.expr(pick(LABELS, "c_nationkey % 7")))
    return table(spark, sf, "customer").select("c_custkey", sc.position_index(label).alias("position_index"))


TURNOVERS = ("Bad Pass", "Out of Bounds - Bad Pass Turnover", "out-of-bounds lost ball", "Traveling", "Double  Dribble",
             "Discontinued Dribble", "Palming", "Offensive Foul", "Shot Clock", "3 second violation")


@register("b8_turnover_class", f"""
    select class, count(*) as n from (select case l_partkey % 10 when 0 then 'bad_pass' when 1 then 'bad_pass'
      when 2 then 'handling' when 3 then 'handling' when 4 then 'handling' when 5 then 'handling' when 6 then 'handling'
      else 'decision' end as class from lineitem) t group by class""")
def turnovers(spark, sf):
    df = table(spark, sf, "lineitem").select(sc.turnover_class(F.expr(pick(TURNOVERS, "l_partkey % 10"))).alias("class"))
    return df.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@register("b9_shot_category", """
    select category, count(*) as n, count(distinct l_partkey) as n_parts from (select l_partkey,
      case when l_linenumber % 2 = 1 then 'P3' when l_quantity / 2 < 6 then 'R' else 'P2' end as category from lineitem) t
    group by category""")
def categories(spark, sf):
    df = table(spark, sf, "lineitem").select("l_partkey", sc.shot_category(
        F.col("l_linenumber") % 2 + 2, F.col("l_quantity") / 2).alias("category"))
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_partkey").alias("n_parts"))


@register("b10_reboundable_final_ft", """
    select l_orderkey, l_linenumber, count(*) as n, cast(sum(case when l_linenumber % 3 + 1 = l_suppkey % 3 + 1 and l_partkey % 4 = 0
      then 1 else 0 end) as bigint) as live from lineitem group by all""")
def final_ft(spark, sf):
    kind = F.expr(pick(("Free Throw", "Free Throw Technical", "Free Throw Flagrant", "Free Throw Clear Path"), "l_partkey % 4"))
    text = F.concat(kind, F.lit(" "), (F.col("l_linenumber") % 3 + 1).cast("string"), F.lit(" of "), (F.col("l_suppkey") % 3 + 1).cast("string"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum(sc.is_reboundable_final_ft(text).cast("bigint")).alias("live"))


@register("b11_text_fields", """
    select c_custkey, 'In' || c_custkey as sub_in, c_name as sub_out, 'A.' || c_nationkey as helper,
      cast(c_nationkey % 3 + 1 as int) as ft_n, 3 as ft_of from customer""")
def text_fields(spark, sf):
    key = F.col("c_custkey").cast("string")
    sub = F.concat(F.lit("SUB: In"), key, F.lit("  FOR "), F.col("c_name"), F.lit(" "))
    shot = F.concat(F.lit("Layup (4 PTS) (A."), F.col("c_nationkey").cast("string"), F.lit(" 7 AST)"))
    n, m = sc.free_throw_numbers(F.concat(F.lit("Free Throw "), (F.col("c_nationkey") % 3 + 1).cast("string"), F.lit(" of 3")))
    came, went = sc.substitution_names(sub)
    return table(spark, sf, "customer").select("c_custkey", came.alias("sub_in"), went.alias("sub_out"),
                                               sc.assist_name(shot).alias("helper"), n.alias("ft_n"), m.alias("ft_of"))


@register("b12_missing_id", """
    select s_suppkey, case when s_nationkey % 4 = 0 then null when s_nationkey % 4 = 1 then null when s_nationkey % 4 = 2 then null
      else nullif(s_suppkey, 0) end as id from supplier""")
def missing(spark, sf):
    kind = F.col("s_nationkey") % 4
    text = F.when(kind == 0, "").when(kind == 1, "0").when(kind == 2, "NaN").otherwise(F.col("s_suppkey").cast("string"))
    return table(spark, sf, "supplier").select("s_suppkey", sc.missing_id(text).alias("id"))


ACTIONS = ("Driving Dunk Shot", "Running Alley Oop Dunk Shot", "Dunk Shot", "Driving Finger Roll Layup Shot", "Layup Shot",
           "Tip Layup Shot", "Driving Hook Shot", "Jump Shot", "Floating Jump shot", "Putback Dunk Shot")
ZONES = ("Restricted Area", "In The Paint (Non-RA)", "Mid-Range", "Backcourt")


@register("b13_shot_bucket", f"""
    select bucket, count(*) as n, cast(sum(l_quantity) as double) as quantity from (select l_quantity, case
      when a in (0, 1) then 'DRIVING_DUNK' when a in (2, 9) then 'STANDING_DUNK' when a = 3 then 'DRIVING_LAYUP'
      when a in (4, 5, 6, 8) and z <= 1 then 'TOUCH' end as bucket
      from (select l_quantity, l_partkey % 10 as a, l_suppkey % 4 as z from lineitem) x) t group by bucket""")
def buckets(spark, sf):
    b = sc.shot_bucket(F.expr(pick(ACTIONS, "l_partkey % 10")), F.expr(pick(ZONES, "l_suppkey % 4")))
    return table(spark, sf, "lineitem").groupBy(b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


BOX = {"FGA": "l_linenumber <= 5", "OREB": "l_linenumber = 6", "TOV": "l_tax >= 0.07", "FTA": "l_linenumber >= 4",
       "AST": "l_discount >= 0.07", "FG3A": "l_linenumber <= 2", "FG3M": "l_linenumber <= 2 and l_discount > 0.055",
       "FTM": "l_linenumber >= 4 and l_discount > 0.025", "FGM": "l_linenumber <= 5 and l_discount > 0.045",
       "DREB": "l_linenumber = 7", "STL": "l_tax < 0.005", "BLK": "l_tax > 0.075", "PF": "l_discount < 0.005"}
BOX_SQL = ", ".join(f"cast(sum(case when {c} then 1 else 0 end) as double) as {k}" for k, c in BOX.items())


def box(spark, sf, key):
    rows = table(spark, sf, "lineitem")
    g = rows.groupBy(key).agg(*[F.sum(F.when(F.expr(c), 1.0).otherwise(0.0)).alias(k) for k, c in BOX.items()],
                              F.count(F.lit(1)).cast("double").alias("N"), F.sum("l_quantity").alias("MIN"))
    return g.withColumn("PTS", 2 * F.col("FGM") + F.col("FG3M") + F.col("FTM"))


def box_sql(key):
    return (f"(select *, 2 * FGM + FG3M + FTM as PTS from (select {key}, {BOX_SQL}, cast(count(*) as double) as N, "
            f"sum(l_quantity) as MIN from lineitem group by {key}) b)")


@register("b14_possessions", f"select l_partkey, {rq('FGA - OREB + TOV + 0.44 * FTA')} as poss from {box_sql('l_partkey')} b")
def poss(spark, sf):
    return box(spark, sf, "l_partkey").select("l_partkey", r(sc.possessions("FGA", "OREB", "TOV", "FTA")).alias("poss"))


@register("b15_creation_and_load", f"""
    select l_partkey, {rq('bc', 9)} as box_creation, {rq('(ast - 0.38 * bc) * 0.75 + fga + 0.44 * fta + bc + tov', 9)} as offensive_load
    from (select *, 0.1843 * ast + 0.0969 * (pts + tov) - 2.3021 * prof + 0.0582 * ast * (pts + tov) * prof - 1.1942 as bc
      from (select l_partkey, AST / N * 10 as ast, PTS / N * 10 as pts, TOV / N * 10 as tov, FGA / N * 10 as fga,
        FTA / N * 10 as fta, (2 / (1 + exp(-FG3A / N * 10)) - 1) * case when FG3A > 0 then FG3M / FG3A else 0 end as prof
        from {box_sql('l_partkey')} b) p) c""")
def load(spark, sf):
    b = box(spark, sf, "l_partkey")
    per = {c: F.col(c) / F.col("N") * 10 for c in ("AST", "PTS", "TOV", "FGA", "FTA", "FG3A")}
    pct = F.when(F.col("FG3A") > 0, sc.safe_div("FG3M", "FG3A")).otherwise(0.0)
    b = b.withColumn("bc", sc.box_creation(per["AST"], per["PTS"], per["TOV"], per["FG3A"], pct))
    return b.select("l_partkey", r("bc", 9).alias("box_creation"), r(sc.offensive_load(
        per["AST"], per["FGA"], per["FTA"], per["TOV"], F.col("bc")), 9).alias("offensive_load"))


@register("b16_game_score", f"""
    select l_orderkey, {rq('(PTS + 0.4 * FGM - 0.7 * FGA - 0.4 * (FTA - FTM) + 0.7 * OREB + 0.3 * DREB + STL + 0.7 * AST + 0.7 * BLK - 0.4 * PF - TOV) / MIN', 9)} as score
    from {box_sql('l_orderkey')} b where MIN >= 10""")
def game_score(spark, sf):
    b = box(spark, sf, "l_orderkey").where("MIN >= 10")
    return b.select("l_orderkey", r(sc.game_score_per_minute({c: c for c in (*BOX, "PTS", "MIN")}), 9).alias("score"))


@register("b17_shooting_attempts", f"""
    select l_partkey, {rq('FGA + 0.44 * FTA')} as tsa, {rq('PTS / nullif(FGA + 0.44 * FTA, 0)')} as points_per_tsa
    from {box_sql('l_partkey')} b""")
def tsa(spark, sf):
    t = sc.shooting_attempts("FGA", "FTA")
    return box(spark, sf, "l_partkey").select("l_partkey", r(t).alias("tsa"), r(sc.safe_div("PTS", t)).alias("points_per_tsa"))


@register("b18_tier", """
    select p_partkey, tier, case tier when -2 then 'Lazy' when -1 then 'Below Average' when 1 then 'High Motor'
      when 2 then 'Relentless' end as tier_name from (select p_partkey, cast(case when z >= 2 then 2 when z >= 1 then 1
      when z <= -2 then -2 when z <= -1 then -1 else 0 end as int) as tier from (select p_partkey, (p_size - 25) / 10.0 as z from part) a) b""")
def tiers(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", sc.tier((F.col("p_size") - 25) / 10.0).alias("tier"))
    return t.select("p_partkey", "tier", sc.tier_name(F.lit("hustle"), "tier").alias("tier_name"))


@register("b19_derived_measures", f"""
    select user_id, {rq('sum(value * n)', 3)} as dribbles, {rq('sum(value * n) / sum(n)')} as weighted_speed,
      {rq('48 * sum(value) / sum(n)')} as per_48 from (select user_id, value, event_id % 5 + 1 as n from events) e group by user_id""")
def measures(spark, sf):
    e = table(spark, sf, "events").select("user_id", "value", (F.col("event_id") % 5 + 1).alias("n"))
    g = e.groupBy("user_id").agg(F.sum(F.col("value") * F.col("n")).alias("x"), F.sum("n").alias("m"), F.sum("value").alias("v"))
    return g.select("user_id", r("x", 3).alias("dribbles"), r(sc.safe_div("x", "m")).alias("weighted_speed"),
                    r(48 * sc.safe_div("v", "m")).alias("per_48"))


@register("b20_name_override", """
    select p_partkey, case when p_partkey % 3 = 0 then 'Box' else split_part(p_name, ' ', 1) end as first_name,
      case when p_partkey % 3 = 0 then 'Score' when strpos(p_name, ' ') = 0 then '' else substr(p_name, strpos(p_name, ' ') + 1) end as last_name
    from part""")
def override(spark, sf):
    first, last = sc.split_display_name("p_name")
    boxed = F.col("p_partkey") % 3 == 0
    return table(spark, sf, "part").select("p_partkey", F.coalesce(F.when(boxed, F.lit("Box")), first).alias("first_name"),
                                           F.coalesce(F.when(boxed, F.lit("Score")), last).alias("last_name"))
