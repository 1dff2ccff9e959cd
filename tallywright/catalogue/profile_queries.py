"""Attributes (I), tendencies and traits (J) of the league read from the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue import league_view as lv
from tallywright.catalogue.base import probit_sql, r, register, rq
from tallywright.plans import specs as sp

LINES = f"lines as ({lv.LINES_SQL})"
CHART = """chart as (select *, case when q < 8 then 'RA' when q < 16 then 'P' when q < 30 then 'M' else 'A' end as zone, case when q + d * 4 > s then 1 else 0 end as made
    from (select *, row_number() over (partition by l_orderkey, n order by strftime(l_shipdate, '%Y-%m-%d'), l_partkey, l_suppkey, floor(q / 2), k) as rn from lines) t where rn = 1),
    zone_u as (select zone, avg(made * case when q >= 30 then 3.0 else 2.0 end) as u from chart group by zone)"""
INPUTS = f"""inp as (select i.*, c.* exclude (player_id) from ({lv.INPUTS_SQL}) i join (select player_id, count(*)::double as CHART_FGA,
    count(case when zone = 'M' then 1 end)::double as CHART_MID_FGA, count(case when q < 12 then 1 end)::double as CHART_RIM_FGA,
    count(case when n = 1 then 1 end)::double as LAYUP_FGA, count(case when n in (2, 5) and q < 16 then 1 end)::double as TOUCH_FGA,
    count(case when n = 3 and made = 1 then 1 end)::double as DRIVING_DUNK_FGM, count(case when n = 4 and made = 1 then 1 end)::double as STANDING_DUNK_FGM
    from chart group by player_id) c on c.player_id = i.player_id where OFF_POSS > 0 and DEF_POSS > 0)"""
PER = {c: f"({c} / (OFF_POSS / 100.0))" for c in ("AST", "PTS", "TOV", "FGA", "FTA", "FG3A")}
PROF = f"((2 / (1 + exp(-{PER['FG3A']})) - 1) * case when FG3A > 0 then FG3M / FG3A else 0 end)"
CREATION = (f"(0.1843 * {PER['AST']} + 0.0969 * ({PER['PTS']} + {PER['TOV']}) - 2.3021 * {PROF} + 0.0582 * {PER['AST']} * "
            f"({PER['PTS']} + {PER['TOV']}) * {PROF} - 1.1942)")
LOAD = f"(({PER['AST']} - 0.38 * {CREATION}) * 0.75 + {PER['FGA']} + 0.44 * {PER['FTA']} + {CREATION} + {PER['TOV']})"
SPEC = {s.name: s for s in sp.ALL_SHRUNK}


def counts_sql(x, n, where="true"):
    return f"(select player_id, ({x})::double as x, ({n})::double as n from inp where {where})"


def beta_sql(x, n):
    c = counts_sql(x, n)
    return (f"(select player_id, case when v > 0 then (x + m * t) / (n + t) else m end as value from (select *, m * (1 - m) / nullif(v, 0) - 1 as t from {c} c, "
            f"(select avg(x / n) as m, var_pop(x / n) - avg(x / n * (1 - x / n) / n) as v from {c} b where n > 0) f) g)")


def gamma_sql(x, n):
    c = counts_sql(x.replace("OFF_LOAD", LOAD), n)
    return (f"(select player_id, case when v > 0 then (x + m * m / v) / (n + m / v) else m end as value from {c} c, "
            f"(select avg(x / n) as m, var_pop(x / n) - avg(x / n) * avg(1 / n) as v from {c} b where n > 0) f)")


def normal_sql(rows, free=False):
    """``rows``: a select of player_id, d, s2 for everyone (NULL d = undefined)."""
    mean = "avg(d) filter (s2 > 0 and d is not null)" if free else "0"
    return (f"(select player_id, case when d is not null and s2 > 0 and t2 > 0 then mu + (d - mu) * t2 / (t2 + s2) else mu end as value from ({rows}) c, "
            f"(select greatest(0, var_pop(d) filter (s2 > 0 and d is not null) - avg(s2) filter (s2 > 0 and d is not null)) as t2, {mean} as mu from ({rows}) b) f)")


def delta_rows(cat, pts):
    a, m, e = f"A_{cat}", f"M_{cat}", f"E_{cat}"
    return (f"select player_id, {pts} * ({e} - {m}) / nullif({a}, 0) as d, {pts} * {pts} * ({e} / nullif({a}, 0)) * (1 - {e} / nullif({a}, 0)) / nullif({a}, 0) as s2 from inp")


CELLS = """select i.player_id, d, s2 from inp i left join (select player_id, (sum(m) - sum(a * q)) / sum(a) as d, sum(a * q * (1 - q)) / (sum(a) * sum(a)) as s2
    from cells join (select g, k, sum(m) / sum(a) as q from cells group by g, k) u using (g, k) group by player_id) c on c.player_id = i.player_id"""
CELL_CTE = """cells as (select player_id, case when q < s then 'C' else 'P' end as g, n % 4 as k, sum(case when d > 5 then 1.0 else 0 end)::double as m,
    count(*)::double as a from lines group by all)"""
HELPED_CTE = "helped as (select (player_id + n * 7) % 350 as player_id, u from chart join zone_u using (zone) where made = 1)"
HELPED = """select i.player_id, h.d, h.s2 from inp i left join (select player_id, avg(u) - (select avg(u) from helped) as d,
    (select var_pop(u) from helped) / count(*) as s2 from helped group by player_id) h on h.player_id = i.player_id"""
LATE = """select player_id, case when lt > 0 and al - lt > 0 then CLUTCH_PTS / lt - (PTS - CLUTCH_PTS) / (al - lt) end as d,
    case when lt > 0 and al - lt > 0 then sg * (1 / lt + 1 / (al - lt)) end as s2 from (select *, CLUTCH_FGA + 0.44 * CLUTCH_FTA as lt, FGA + 0.44 * FTA as al from inp) x,
    (select sum((p - mu * t) ** 2) / sum(t) as sg from games, (select sum(p) / sum(t) as mu from games) m) y"""
GAMES_CTE = f"""games as (select player_id, l_orderkey, sum({lv.ROW_COUNTS['PTS']})::double as p, (sum({lv.ROW_COUNTS['FGA']}) + 0.44 * sum({lv.ROW_COUNTS['FTA']}))::double as t
    from lines group by player_id, l_orderkey)"""
BLOCK_RATE = {c: f"(select sum(pbp_blocks_{c}) / sum(A_{c}) from inp)" for c in ("R", "P2", "P3")}
EXPECTED = " + ".join(f"A_{c} * {v}" for c, v in BLOCK_RATE.items())
RISK = (f"(select player_id, case when ik > 0 and e > 0 then (o + 1 / ik) / (e + 1 / ik) else 1 end as value from (select player_id, pbp_blocks as o, {EXPECTED} as e from inp) c, "
        f"(select greatest(0, var_pop(o / e) - avg(1 / e)) as ik from (select pbp_blocks as o, {EXPECTED} as e from inp) b where e > 0) f)")


def stat_sql(name):
    special = {
        "delta_P3": lambda: normal_sql(delta_rows("P3", 3.0)), "delta_P2": lambda: normal_sql(delta_rows("P2", 2.0)),
        "E2 3P d": lambda: normal_sql(CELLS), "assisted-shot quality d": lambda: normal_sql(HELPED), "RR_BLK": lambda: RISK,
        "clutch PPTSA delta": lambda: normal_sql(LATE, True),
        "net perimeter points saved": perimeter_sql, "post points saved": post_sql, "help contests residual": help_sql,
    }
    if name in special:
        return special[name]()
    s = SPEC[name]
    return (beta_sql if s.family == "beta" else gamma_sql)(s.x, s.n)


def perimeter_sql():
    use = {"d3": "delta_P3", "d2": "delta_P2", "p3": "D_FGA P3 per100", "p2": "D_FGA P2 per100", "al": "D_FGA Overall per100", "phi": "FOUL%"}
    joins = " ".join(f"join {stat_sql(s)} {a} on {a}.player_id = i.player_id" for a, s in use.items())
    return (f"(select i.player_id, p3.value * d3.value + p2.value * d2.value - 1.4 * (phi.value - avg(phi.value) over ()) * al.value * (A_P3 + A_P2) / A_Overall as value "
            f"from inp i {joins})")


def post_sql():
    return (f"(select i.player_id, v.value * ((select sum(SYN_D_Postup_PTS) / sum(SYN_D_Postup_POSS) from inp) - p.value) as value from inp i "
            f"join {stat_sql('defensive Postup possessions per100')} v on v.player_id = i.player_id join {stat_sql('defensive Postup PPP')} p on p.player_id = i.player_id)")


def help_sql():
    j = (f"(select c.player_id, c.value as y, a.value as x from {stat_sql('contested shots per100')} c join {stat_sql('D_FGA Overall per100')} a on a.player_id = c.player_id)")
    return f"(select player_id, y - b * x - c0 as value from {j} j, (select regr_slope(y, x) as b, regr_intercept(y, x) as c0 from {j} k) f)"


def pct_sql(sub, col="value"):
    return (f"(select player_id, {col}, (rank() over (order by {col}) - 1 + 0.5 * count(*) over (partition by {col})) / count(*) over () as pct from {sub} t)")


def score_sql(field):
    parts = [p for p in sp.COMPONENTS if p.field == field and p.weight]
    joins, terms = [], []
    for i, p in enumerate(parts):
        if p.transform == "raw":
            sub, col = stat_sql(p.stat), "value"
        else:
            sub, col = f"(select player_id, {probit_sql('pct')} as z from {pct_sql(rounded(stat_sql(p.stat), 'value'))} q)", "z"
        joins.append(f"join {sub} c{i} on c{i}.player_id = inp.player_id")
        terms.append(f"{p.weight * p.sign!r}::double * c{i}.{col}")
    return f"(select inp.player_id, {' + '.join(terms)} as score from inp {' '.join(joins)})"


def rounded(sub, col="score"):
    """Numbers that are equal by construction tie whatever order their parts were added in."""
    return f"(select player_id, round({col}, 11) as {col} from {sub} r)"


def with_ctes(*more):
    return "with " + ", ".join([LINES, CHART, INPUTS, *more]) + " "


# attribute -> inventory number; fields with closed forms carry SQL, fitted ones are rows-only
NUMBERED = ("driving_layup", "driving_dunk", "standing_dunk", "touch", "post_scoring", "three_pointer", "mid_range", "free_throw",
            "ball_handle", "passing_accuracy", "vision", "offensive_iq", "offensive_rebounding", "defensive_rebounding", "steals",
            "shot_blocking", "on_ball_defense", "post_defense", "rim_protection", "off_ball_defense", "defensive_iq", "speed",
            "acceleration", "lateral_quickness", "vertical", "strength", "stamina")
EXTRA_CTE = {"three_pointer": [CELL_CTE], "vision": [HELPED_CTE]}
CLOSED = ("driving_dunk", "standing_dunk", "post_scoring", "three_pointer", "free_throw", "vision", "offensive_rebounding",
          "defensive_rebounding", "steals", "shot_blocking", "on_ball_defense", "post_defense", "off_ball_defense")


def attribute_query(name):
    def run(spark, sf):
        _d, p = lv.profiles(spark, sf, models=name not in CLOSED)
        a = p.attributes.where(F.col("attribute") == name)
        return a.select("player_id", r("score", 5).alias("score"), r("rating", 4).alias("rating"))
    run.__doc__ = f"Score and rating of {name} for every player of the league view."
    return run


for number, attribute in enumerate(NUMBERED, 1):
    oracle = None
    if attribute in CLOSED:
        oracle = (with_ctes(*EXTRA_CTE.get(attribute, [])) + f"select player_id, {rq('score', 5)} as score, {rq('99 * pct', 4)} as rating from "
                  f"{pct_sql(rounded(score_sql(attribute)), 'score')} s")
    register(f"i{number}_{attribute}", oracle)(attribute_query(attribute))


def tendency_sql():
    rows = [f"select player_id, '{t.name}' as tendency, ({t.x})::double as numerator, ({t.n})::double as denominator from inp" for t in sp.TENDENCIES]
    return (with_ctes(f"long as ({' union all '.join(rows)})",
                      "fit as (select tendency, avg(numerator / denominator) as m, var_pop(numerator / denominator) - avg(numerator / denominator * "
                      "(1 - numerator / denominator) / denominator) as v from long where denominator > 0 group by tendency)")
            + f"select player_id, tendency, {rq('numerator', 2)} as numerator, {rq('denominator', 2)} as denominator, "
            f"{rq('numerator / nullif(denominator, 0)')} as raw_rate, "
            f"{rq('case when v > 0 then (numerator + m * (m * (1 - m) / v - 1)) / (denominator + m * (1 - m) / v - 1) else m end')} as value from long join fit using (tendency)")


@register("j1_tendencies", tendency_sql())
def tendencies(spark, sf):
    """All twenty tendencies, fitted in one grouped aggregate."""
    _d, p = lv.profiles(spark, sf, models=False)
    return p.tendencies.select("player_id", "tendency", r("numerator", 2).alias("numerator"), r("denominator", 2).alias("denominator"),
                               r("raw_rate").alias("raw_rate"), r("value").alias("value"))


@register("j2_tendency_placeholder", with_ctes() + f"select 'rim_attempt_rate' as tendency, count(*) as n, "
          f"{rq('avg(CHART_RIM_FGA / CHART_FGA)')} as prior_mean from inp")
def placeholder(spark, sf):
    """The prior mean a player without exposure gets."""
    _d, p = lv.profiles(spark, sf, models=False)
    return p.priors.where("kind = 'tendency' and name = 'rim_attempt_rate'").select(
        F.col("name").alias("tendency"), F.col("n_entities").alias("n"), r("mean").alias("prior_mean"))


def trait(name, models=False):
    def run(spark, sf):
        _d, p = lv.profiles(spark, sf, models=models)
        t = p.traits.where(F.col("trait") == name)
        return t.select("player_id", r("value", 5).alias("value"), r("z_score", 4).alias("z_score"), "tier", "tier_name")
    run.__doc__ = f"Trait {name}: value, standard score and tier."
    return run


def trait_sql(name, sub, sign, ctes=()):
    names = sp_names(name)
    return (with_ctes(*ctes) + f"select player_id, {rq('value', 5)} as value, {rq('z', 4)} as z_score, tier, case tier {names} end as tier_name from (select *, "
            f"cast(case when z >= 2 then 2 when z >= 1 then 1 when z <= -2 then -2 when z <= -1 then -1 else 0 end as int) as tier from (select player_id, value, "
            f"case when stddev_pop(value) over () <= 1e-12 * greatest(1.0, abs(avg(value) over ())) then 0 else {sign} * (value - avg(value) over ()) / "
            f"stddev_pop(value) over () end as z from {sub} t) u) w")


def sp_names(name):
    from tallywright.functions.scalars import TIER_NAMES
    quote = "'"
    return " ".join(f"when {i - 2} then '{n.replace(quote, quote * 2)}'" for i, n in enumerate(TIER_NAMES[name]) if n)


HUSTLE = f"(select player_id, score as value from {score_sql('trait:hustle')} h)"
register("j3_durability", trait_sql("durability", stat_sql("durability: games missed / roster games"), "-1"))(trait("durability"))
register("j4_consistency")(trait("consistency", models=True))
register("j5_clutch", trait_sql("clutch", stat_sql("clutch PPTSA delta"), "1", [GAMES_CTE]))(trait("clutch"))
register("j6_hustle", trait_sql("hustle", HUSTLE, "1"))(trait("hustle"))

RUNS = """(select player_id, -(case when n1 > 0 and n1 < n and (mu - 1) * (mu - 2) > 0 then (runs - mu) / sqrt((mu - 1) * (mu - 2) / (n - 1)) else 0 end) + 0.0 as value from (
    select *, 2.0 * n1 * (n - n1) / n + 1 as mu from (select player_id, count(*) as n, sum(made) as n1, 1 + sum(ch) as runs from (select *, case when made <> lag(made)
      over (partition by player_id order by strftime(l_shipdate, '%Y-%m-%d'), l_orderkey::varchar, n % 4, -(s % 12 * 60 + d * 5), n) then 1 else 0 end as ch from chart) c
      group by player_id) g) h)"""
register("j7_streaky", with_ctes() + f"select player_id, {rq('value', 5)} as value, {rq('value', 4)} as z_score, tier, case tier {sp_names('streaky')} end as tier_name "
         f"from (select *, cast(case when value >= 2 then 2 when value >= 1 then 1 when value <= -2 then -2 when value <= -1 then -1 else 0 end as int) as tier from {RUNS} t) u")(
    trait("streaky"))


@register("j8_tier_histogram")
def tier_histogram(spark, sf):
    """Players per trait and tier, all five traits."""
    _d, p = lv.profiles(spark, sf)
    return p.traits.groupBy("trait", "tier", "tier_name").agg(F.count(F.lit(1)).alias("n"))


@register("j9_players", with_ctes() + """
    , b as (select player_id, player_id % 30 + 1 as team_id, FGA, FGM, CLUTCH_FGA, row_number() over (partition by player_id % 30 order by CLUTCH_FGA desc, FGA desc, player_id) as lead from inp)
    select player_id, team_id, 'Size' as first_name, cast(lead <= 5 as int) as starter, cast(case when lead <= 5 then lead else 5 + row_number() over (
      partition by team_id, lead <= 5 order by FGA desc, CLUTCH_FGA desc, player_id) end as int) as depth_rank, 0 as no_data from b""".strip())
def players(spark, sf):
    """Roster rows with names, depth order and flags."""
    from tallywright.functions.scalars import split_display_name
    from tallywright.operators.ranks import depth_rank
    d, _p = lv.profiles(spark, sf, models=False)
    who = d.lg.roster.select("player_id", "team_id", split_display_name("display_name")[0].alias("first_name"))
    use = d.lg.inputs.select("player_id", F.col("CLUTCH_FGA").alias("games_started"), F.col("FGA").alias("minutes_per_game"))
    ranked = depth_rank(who.join(use, "player_id"), "team_id", "player_id", "games_started", "minutes_per_game")
    flagged = ranked.join(d.wide.select("player_id", F.lit(0).alias("seen")), "player_id", "left")
    return flagged.select("player_id", "team_id", "first_name", (F.col("depth_rank") <= 5).cast("int").alias("starter"), "depth_rank",
                          F.when(F.col("seen").isNull(), 1).otherwise(0).alias("no_data"))


@register("j10_components")
def components(spark, sf):
    """The audit trail: every component of every score with its value and transform."""
    _d, p = lv.profiles(spark, sf)
    return p.components.select("player_id", "field", "component", r("value", 4).alias("value"), r("z", 4).alias("z"))


@register("j10_blend_weights")
def weights(spark, sf):
    return lv.profiles(spark, sf)[1].weights.select("field", "component", r("weight", 4).alias("weight"))


@register("j10_model_parameters")
def parameters(spark, sf):
    return lv.profiles(spark, sf)[1].parameters.select("model", "key", r("value", 3).alias("value"))


@register("j11_placeholder_fill", """
    select l_partkey, case when x > 0 then 0 else 1 end as placeholder, case when x > 0 then """ + rq("99 * (rk - 1 + 0.5 * tied) / nullif(m, 0)", 8) + """ else 40.0 end as rating
    from (select *, rank() over (partition by x > 0 order by x) as rk, count(*) over (partition by x) as tied, count(*) over (partition by x > 0) as m from (
      select l_partkey, sum(case when l_returnflag = 'R' and l_linenumber = 1 then l_quantity else 0 end)::double as x from lineitem group by l_partkey) t) u""")
def fill(spark, sf):
    """Parts without exposure get the flagged placeholder; the rest are rated among themselves."""
    from tallywright.catalogue.base import table
    from tallywright.operators.ranks import rate_scores
    back = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.col("l_quantity")).otherwise(0)
    g = table(spark, sf, "lineitem").groupBy(F.lit("x").alias("stat"), "l_partkey").agg(F.sum(back).cast("double").alias("score"))
    rated = rate_scores(g.where("score > 0"), ["stat"], "score").select("l_partkey", F.lit(0).alias("placeholder"), r("rating", 8).alias("rating"))
    none = g.where("score <= 0").select("l_partkey", F.lit(1).alias("placeholder"), F.lit(sp.PLACEHOLDER_RATING).alias("rating"))
    return rated.unionByName(none)
