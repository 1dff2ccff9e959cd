"""Event logs (K), lineups (F14, F15) and counts on the floor (E3, E4, E6) from the events table.

A game is (day, block of twenty users); a user's side is its parity. Users k and k + 10 of a block
share one place: a signup swaps them, everything else is done by whoever holds the place. So every
side has five places, and the lineup at any event follows from the signups before it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.catalogue.base import r, register, rq, table
from tallywright.operators.ordered import ordered_scan, plan_cuts
from tallywright.plans.game_log import derive_game_tables
from tallywright.plans.lineage import cut

# users 0-19 of block b are ids 20 b .. 20 b + 19; place = id % 10, held by the lower id at first
LOG = """ev as (select *, strftime(ts, '%Y-%m-%d') || '/' || (user_id // 20) as game, cast(hour(ts) // 6 + 1 as int) as period, user_id % 2 as side,
      user_id // 20 * 20 + user_id % 10 as low, epoch_us(ts) as at from events),
    held as (select *, cast(coalesce(sum(case when event_type = 'signup' then 1 else 0 end) over (partition by game, low order by ts, event_id
      rows between unbounded preceding and 1 preceding), 0) as bigint) as swaps, row_number() over (partition by game order by ts, event_id) as ord from ev),
    log as (select *, low + 10 * (swaps % 2) as person, low + 10 * (1 - swaps % 2) as other,
      'PT' || ((21600 - (hour(ts) % 6 * 3600 + minute(ts) * 60 + second(ts))) // 30 // 60) || 'M' ||
      lpad(((21600 - (hour(ts) % 6 * 3600 + minute(ts) * 60 + second(ts))) // 30 % 60)::varchar, 2, '0') || '.00S' as clock from held)"""
TEAM = "side + 1"          # team ids 1 and 2; user ids are shifted by 100 to stay clear of them


def placed(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    block = F.floor(F.col("user_id") / 20)
    e = e.select("*", F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("/"), block.cast("string")).alias("game_id"),
                 (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"), (F.col("user_id") % 2).alias("side"),
                 (block * 20 + F.col("user_id") % 10).alias("low"))
    swap = F.when(F.col("event_type") == "signup", 1).otherwise(0)
    e = ordered_scan(e, ["game_id", "low"], ["ts", "event_id"], {"swaps": ("sum_before", swap)}, plan_cuts(e, ["game_id", "low"], "ts"))
    e = ordered_scan(e, ["game_id"], ["ts", "event_id"], {"ord": ("sum", F.lit(1).cast("bigint"))}, plan_cuts(e, ["game_id"], "ts"))
    left = F.floor((21600 - (F.hour("ts") % 6 * 3600 + F.minute("ts") * 60 + F.second("ts"))) / 30)
    flip = F.col("swaps") % 2
    return e.select("*", (F.col("low") + 10 * flip).alias("person"), (F.col("low") + 10 * (1 - flip)).alias("replacement"),
                    F.format_string("PT%dM%02d.00S", F.floor(left / 60), F.floor(left % 60)).alias("clock"))


def id_log(spark, sf):
    """The id dialect: purchase = made two, error = missed two, click = rebound, view = turnover,
    signup = one row out and one row in."""
    k = F.col("event_type")
    kind = F.when(k.isin("purchase", "error"), "2pt").when(k == "click", "rebound").when(k == "view", "turnover").otherwise("substitution")
    row = F.struct(F.lit(0).alias("second"), F.col("person").alias("who"), F.lit("out").alias("way"))
    pair = F.array(row, F.struct(F.lit(1).alias("second"), F.col("replacement").alias("who"), F.lit("in").alias("way")))
    each = placed(spark, sf).withColumn("x", F.explode(F.when(k == "signup", pair).otherwise(F.array(row))))
    return each.select(
        "game_id", (F.col("ord") * 2 + F.col("x.second")).alias("ord"), F.col("event_id").alias("actionNumber"), "clock", "period",
        (F.col("side") + 1).alias("teamId"), (F.col("x.who") + 100).alias("personId"), kind.alias("actionType"),
        F.when(k == "signup", F.col("x.way")).when(k == "view", "bad pass").otherwise("").alias("subType"), F.lit("").alias("descriptor"),
        F.when(k == "purchase", "Made").when(k == "error", "Missed").alias("shotResult"), (F.col("value") / 10).alias("shotDistance"),
        F.lit(None).cast("bigint").alias("assistPersonId"), F.lit(None).cast("bigint").alias("blockPersonId"),
        F.lit(None).cast("bigint").alias("foulDrawnPersonId"), F.lit(None).cast("bigint").alias("possession"))


def text_log(spark, sf):
    """The text dialect of the same rows: makes, helpers and substitutes are only in the text."""
    k = F.col("event_type")
    name = F.concat(F.lit("U"), F.col("person").cast("string"))
    kind = (F.when(k == "purchase", "Made Shot").when(k == "error", "Missed Shot").when(k == "click", "Rebound").when(k == "view", "Turnover")
            .otherwise("Substitution"))
    text = (F.when(k == "purchase", F.concat(name, F.lit(" Layup (2 PTS) (U"), F.col("low").cast("string"), F.lit(" 1 AST)")))
            .when(k == "error", F.concat(F.lit("MISS "), name, F.lit(" 3PT Jump Shot")))
            .when(k == "signup", F.concat(F.lit("SUB: U"), F.col("replacement").cast("string"), F.lit(" FOR "), name)).otherwise(name))
    return placed(spark, sf).select(
        "game_id", "ord", F.col("event_id").alias("actionNumber"), "clock", "period", (F.col("side") + 1).alias("teamId"),
        (F.col("person") + 100).alias("personId"), kind.alias("actionType"), F.when(k == "view", "Lost Ball").otherwise("").alias("subType"),
        text.alias("description"), F.lit(None).cast("string").alias("shotResult"), k.isin("purchase", "error").cast("int").alias("isFieldGoal"),
        F.lit(None).cast("int").alias("shotValue"), (F.col("value") / 10).alias("shotDistance"), name.alias("playerName"))


def box_score(spark, sf):
    """Everyone of a block is in its games' box scores; the first ten start."""
    block = F.floor(F.col("user_id") / 20)
    games = table(spark, sf, "events").select(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("/"), block.cast("string")).alias("game_id"),
                                              (block * 20).alias("base")).distinct()
    each = games.withColumn("u", F.explode(F.sequence(F.col("base"), F.col("base") + 19)))
    return each.select("game_id", (F.col("u") + 100).alias("person_id"), (F.col("u") % 2 + 1).alias("team_id"),
                       F.concat(F.lit("U"), F.col("u").cast("string")).alias("family_name"), F.lit("").alias("first_name"),
                       F.when(F.col("u") % 20 < 10, "G").otherwise("").alias("position"), F.lit("10:00").alias("minutes"))


_done: dict = {}


def tables(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _done:
        _done[key] = derive_game_tables(cut(box_score(spark, sf)), id_log=cut(id_log(spark, sf)))
    return _done[key]


ELAPSED = "cast(p * 7200 - round(((21600 - (hour(ts) % 6 * 3600 + minute(ts) * 60 + second(ts))) // 30) * 10) as int)".replace("p *", "period *")


@register("k1_text_dialect", f"""
    with {LOG} select event_id, game, period, {ELAPSED} as t, case event_type when 'purchase' then 'fga' when 'error' then 'fga' when 'click' then 'reb'
      when 'view' then 'tov' else 'sub' end as kind, {TEAM} as team, person + 100 as person, event_type = 'purchase' as made,
      case event_type when 'purchase' then 2 when 'error' then 3 else 0 end as value, case when event_type = 'signup' then 'U' || other end as in_name,
      case when event_type = 'purchase' then 'U' || low end as assist_name from log""")
def text_dialect(spark, sf):
    from tallywright.operators.events import game_rosters, normalize_text_log
    log = text_log(spark, sf).withColumn("raw", F.col("actionNumber"))
    evs = normalize_text_log(log, game_rosters(box_score(spark, sf)), plan_cuts(log, ["game_id"], "ord"))
    j = evs.join(log.select("game_id", "ord", "raw"), ["game_id", "ord"])
    return j.select(F.col("raw").alias("event_id"), F.col("game_id").alias("game"), "period", "t", "kind", "team", "person", "made", "value", "in_name", "assist_name")


@register("k2_id_dialect", f"""
    with {LOG}, f as (select *, lag(event_type) over w as pt, lag(side) over w as ps, lag(period) over w as pp, lag(clock) over w as pc from log
      window w as (partition by game order by ord)), h as (select *, sum(case when event_type = 'signup' and pt = 'signup' and ps = side and pp = period and pc = clock
      then 0 else 1 end) over (partition by game order by ord rows between unbounded preceding and current row) as g from f)
    select game, min(period) as period, min({ELAPSED}) as t, min(case event_type when 'purchase' then 'fga' when 'error' then 'fga' when 'click' then 'reb'
      when 'view' then 'tov' else 'sub' end) as kind, min({TEAM}) as team, bool_or(event_type = 'purchase') as made, min(ord) * 2 as ord,
      count(case when event_type = 'signup' then 1 end) as n_out, count(case when event_type = 'signup' then 1 end) as n_in from h group by game, g""")
def id_dialect(spark, sf):
    from tallywright.operators.events import game_rosters, normalize_id_log
    log = id_log(spark, sf)
    evs = normalize_id_log(log, game_rosters(box_score(spark, sf)), plan_cuts(log, ["game_id"], "ord"))
    return evs.select(F.col("game_id").alias("game"), "period", "t", "kind", "team", "made", "ord", F.size("outs").cast("bigint").alias("n_out"),
                      F.size("ins").cast("bigint").alias("n_in"))


@register("k3_presence", """
    select event_type, count(*) as n, cast(sum(case when event_type = 'signup' then 0 when event_type = 'error' and event_id % 2 = 0 then 0 else 1 end) as bigint) as proves
    from events group by event_type""")
def presence(spark, sf):
    """Which rows prove someone is on the floor: not substitutions, not technical fouls."""
    from tallywright.operators.events import proves_presence
    k = F.col("event_type")
    e = table(spark, sf, "events").select(
        "event_type", F.when(k == "signup", "sub").when(k == "error", "foul").when(k == "view", "tov").when(k == "click", "reb").otherwise("fga").alias("kind"),
        F.when(F.col("event_id") % 2 == 0, "technical").otherwise("personal").alias("sub"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(proves_presence().cast("bigint")).alias("proves"))


@register("k4_team_events", f"""
    with {LOG} select event_id, {TEAM} as team, case when event_id % 3 <> 0 then person + 100 end as person from log""")
def team_events(spark, sf):
    """A person id equal to a team id, with team id 0, makes a team event."""
    from tallywright.operators.events import _sides, game_rosters
    log = placed(spark, sf)
    whole = F.col("event_id") % 3 == 0
    log = log.select("game_id", "event_id", F.when(whole, 0).otherwise(F.col("side") + 1).alias("teamId"),
                     F.when(whole, F.col("side") + 1).otherwise(F.col("person") + 100).alias("personId"))
    return _sides(log, game_rosters(box_score(spark, sf))).select("event_id", "team", "person")


@register("k5_foul_accounting", f"""
    with {LOG}, s as (select *, last_value(case event_type when 'purchase' then 1 - side when 'click' then side end ignore nulls) over (partition by game
      order by ord rows between unbounded preceding and 1 preceding) as holder from log)
    select person + 100 as player_id, case when event_id % 5 = 0 then 'shooting_fouls' when event_id % 5 = 1 then 'offensive_fouls_drawn' else 'nonshooting_def_fouls' end as field,
      count(*)::double as value from s where event_type = 'error' and event_id % 5 <> 2 and (event_id % 5 in (0, 1) or holder <> side) group by all""")
def fouls(spark, sf):
    """Errors read as fouls of four kinds; the defensive ones need the other side in possession."""
    from tallywright.operators.lineups import player_event_counts
    e = placed(spark, sf)
    k = F.col("event_type")
    sig = F.when(k == "purchase", 1 - F.col("side")).when(k == "click", F.col("side"))
    e = ordered_scan(e, ["game_id"], ["ord"], {"holder": ("last_before", sig)}, plan_cuts(e, ["game_id"], "ord"))
    five = F.col("event_id") % 5
    e = e.where(k == "error").select(
        (F.col("side") + 1).alias("team"), F.lit("foul").alias("kind"), (F.col("person") + 100).alias("person"), (F.col("person") + 100).alias("drawn"),
        F.when(five == 0, "personal shooting").when(five == 1, "offensive charge").when(five == 2, "technical").otherwise("personal").alias("sub"),
        (F.col("holder") + 1).alias("possession_before"), (F.col("side") + 1).alias("person_team"), (F.col("side") + 1).alias("drawn_team"),
        F.lit(True).alias("person_played"), F.lit(None).cast("bigint").alias("blocker"), F.lit(None).cast("bigint").alias("blocker_team"),
        F.lit(None).cast("bigint").alias("block_by"), F.lit(None).cast("bigint").alias("block_team"), F.lit(False).alias("made"), F.lit(0).alias("value"),
        F.lit(None).cast("double").alias("distance"))
    return player_event_counts(e)


@register("k6_rotation_intervals", """
    select cast(cast(ts as date) as varchar) as game_id, user_id as player_id, user_id % 2 as team, cast(round_even(value * 10, 0) as int) as t_in,
      cast(round_even(value * 10 + 5.25, 0) as int) as t_out from events where event_type = 'signup'""")
def rotation(spark, sf):
    from tallywright.operators.events import rotation_intervals
    e = table(spark, sf, "events").where("event_type = 'signup'").select(
        F.date_format("ts", "yyyy-MM-dd").alias("game_id"), F.col("user_id").alias("PERSON_ID"), (F.col("user_id") % 2).alias("TEAM_ID"),
        (F.col("value") * 10).alias("IN_TIME_REAL"), (F.col("value") * 10 + 5.25).alias("OUT_TIME_REAL"))
    return rotation_intervals(e)


# five places per side, each with its holder at every counted event
FLOOR = f"""with {LOG}, miss as (select *, last_value(case event_type when 'error' then side when 'purchase' then -1 when 'click' then -1 when 'view' then -1 end ignore nulls)
      over (partition by game, period order by ord rows between unbounded preceding and 1 preceding) as miss from log),
    spot as (select m.*, p.place from miss m, (select unnest(range(10)) as place) p where m.event_type <> 'signup'),
    held2 as (select s.*, (user_id // 20 * 20 + s.place) as plow, s.place % 2 as pside from spot s),
    swaps as (select game, low, ord, count(*) over (partition by game, low order by ord) as k from log where event_type = 'signup'),
    who as (select h.*, h.plow + 10 * (coalesce(w.k, 0) % 2) + 100 as player_id from held2 h asof left join swaps w on h.game = w.game and h.plow = w.low and h.ord >= w.ord)"""


@register("e3_on_floor_counts", f"""
    {FLOOR} select player_id, pside + 1 as team_id,
      count(case when pside = side and event_type in ('purchase', 'error') then 1 end)::double as team_fga, count(case when pside = side and event_type = 'purchase' then 1 end)::double as team_fgm,
      count(case when pside = side and event_type = 'click' and miss = side then 1 end)::double as team_oreb, count(case when pside = side and event_type = 'click' and miss >= 0 and miss <> side then 1 end)::double as team_dreb,
      count(case when pside = side and event_type = 'view' then 1 end)::double as team_tov, count(case when pside <> side and event_type in ('purchase', 'error') then 1 end)::double as opp_fga,
      count(case when pside <> side and event_type = 'error' then 1 end)::double as opp_missed_fga, count(case when pside <> side and event_type = 'view' then 1 end)::double as opp_tov,
      count(case when pside <> side and event_type = 'click' and miss = side then 1 end)::double as opp_oreb
    from who where event_type <> 'click' or miss >= 0 group by player_id, pside""")
def on_floor(spark, sf):
    """Counts for and against everyone on the floor, from the rebuilt lineups."""
    t = tables(spark, sf).on_floor
    return t.select("player_id", "team_id", "team_fga", "team_fgm", "team_oreb", "team_dreb", "team_tov", "opp_fga", "opp_missed_fga", "opp_tov", "opp_oreb")


@register("e4_player_events", f"""
    with {LOG} select person + 100 as player_id, 'tov_bad_pass' as field, count(*)::double as value from log where event_type = 'view' group by person""")
def player_events(spark, sf):
    return tables(spark, sf).player_events.select("player_id", "field", "value")


@register("e6_stint_totals", f"""
    with {LOG} select game as game_id, side + 1 as offense_team, {rq("sum(case when event_type = 'purchase' then 2 else 0 end)")} as pts,
      count(case when event_type in ('purchase', 'error') then 1 end)::double as fga from log group by game, side""")
def stints(spark, sf):
    """Points and shots of all ten-man stints, summed per game and side."""
    s = tables(spark, sf).stints.groupBy("game_id", "offense_team").agg(r(F.sum("pts")).alias("pts"), F.sum("fga").alias("fga"))
    played = tables(spark, sf).events.where("kind <> 'period'").select("game_id", F.col("team").alias("offense_team")).distinct()
    return s.join(played, ["game_id", "offense_team"], "left_semi")


@register("f14_period_starters", f"""
    with {LOG}, per as (select distinct game, period from log), spot as (select per.*, p.place from per, (select unnest(range(10)) as place) p),
    sw as (select game, low, period, count(*) as k from log where event_type = 'signup' group by all),
    st as (select s.game, s.period, s.place, split_part(s.game, '/', 2)::bigint * 20 + s.place as plow, s.place % 2 as pside from spot s),
    fin as (select st.game, st.period, st.pside, st.plow + 10 * (coalesce((select sum(k) from sw where sw.game = st.game and sw.low = st.plow and sw.period < st.period), 0) % 2) + 100 as u from st)
    select game as game_id, period, pside + 1 as team, string_agg(cast(u as bigint)::varchar, ',' order by u) as starters from fin group by all""")
def starters(spark, sf):
    s = tables(spark, sf).segments.where("seg_no = 0")
    return s.select("game_id", "period", "team", F.array_join(F.transform(F.array_sort("players"), lambda p: p.cast("string")), ",").alias("starters"))


# one-period games whose log tells who leaves but not who comes: only the first substitution of a side is in the log
LOST = """with ev as (select *, strftime(ts, '%Y-%m-%d') || '/' || (user_id // 20) || '/' || (hour(ts) // 6) as game, user_id % 2 as side,
      user_id // 20 * 20 + user_id % 10 as low from events),
    first_swap as (select event_id from ev where event_type = 'signup' qualify row_number() over (partition by game, side order by ts, event_id) = 1),
    log as (select *, row_number() over (partition by game order by ts, event_id) as ord from ev where event_type <> 'signup' or event_id in (select event_id from first_swap)),
    lost as (select s.game, s.ord, exists (select 1 from log a where a.game = s.game and a.low = s.low and a.ord > s.ord) as found from log s where event_type = 'signup'),
    counted as (select *, last_value(case event_type when 'error' then side when 'signup' then null else -1 end ignore nulls)
      over (partition by game order by ord rows between unbounded preceding and 1 preceding) as miss from log)"""


def lossy_log(spark, sf):
    """(box score, id log) of these games; a newcomer is only known once they act."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    block = F.floor(F.col("user_id") / 20)
    quarter = F.floor(F.hour("ts") / 6)
    e = e.select("*", F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), block.cast("string"), quarter.cast("string")).alias("game_id"),
                 (F.col("user_id") % 2).alias("side"), block.alias("block"), (block * 20 + F.col("user_id") % 10).alias("low"))
    swap = F.col("event_type") == "signup"
    first = e.where(swap).groupBy("game_id", "side").agg(F.min(F.struct("ts", "event_id")).alias("s")).select("game_id", "side", F.col("s.event_id").alias("first_swap"))
    e = e.join(first, ["game_id", "side"], "left").where(~swap | (F.col("event_id") == F.col("first_swap")))
    e = ordered_scan(e, ["game_id"], ["ts", "event_id"], {"ord": ("sum", F.lit(1).cast("bigint"))}, plan_cuts(e, ["game_id"], "ts"))
    e = ordered_scan(e, ["game_id", "low"], ["ord"], {"swaps": ("sum_before", swap.cast("int"))}, plan_cuts(e, ["game_id", "low"], "ord"))
    k = F.col("event_type")
    left = F.floor((21600 - (F.hour("ts") % 6 * 3600 + F.minute("ts") * 60 + F.second("ts"))) / 30)
    log = e.select(
        "game_id", "ord", F.col("event_id").alias("actionNumber"), F.format_string("PT%dM%02d.00S", F.floor(left / 60), F.floor(left % 60)).alias("clock"),
        F.lit(1).alias("period"), (F.col("side") + 1).alias("teamId"), (F.col("low") + 10 * F.col("swaps") + 100).alias("personId"),
        F.when(k.isin("purchase", "error"), "2pt").when(k == "click", "rebound").when(k == "view", "turnover").otherwise("substitution").alias("actionType"),
        F.when(swap, "out").when(k == "view", "bad pass").otherwise("").alias("subType"), F.lit("").alias("descriptor"),
        F.when(k == "purchase", "Made").when(k == "error", "Missed").alias("shotResult"), (F.col("value") / 10).alias("shotDistance"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("assistPersonId", "blockPersonId", "foulDrawnPersonId", "possession")])
    each = e.select("game_id", (F.col("block") * 20).alias("base")).distinct().withColumn("u", F.explode(F.sequence(F.col("base"), F.col("base") + 19)))
    box = each.select("game_id", (F.col("u") + 100).alias("person_id"), (F.col("u") % 2 + 1).alias("team_id"),
                      F.concat(F.lit("U"), F.col("u").cast("string")).alias("family_name"), F.lit("").alias("first_name"),
                      F.when(F.col("u") % 20 < 10, "G").otherwise("").alias("position"), F.lit("10:00").alias("minutes"))
    return cut(box), cut(log)


def lossy_tables(spark, sf):
    box, log = lossy_log(spark, sf)
    return derive_game_tables(box, id_log=log)


@register("f15_lineup_notes", f"""
    {LOST} select note, count(*) as n from (select 'subs_unresolved' as note from lost union all select 'lineups_recovered_mid_period' from lost where found) group by note""")
def lineup_notes(spark, sf):
    """Lineups lost to a substitution without a newcomer, and those found again."""
    return lossy_tables(spark, sf).notes.groupBy("note").agg(F.count(F.lit(1)).alias("n"))


@register("f15_lost_lineups", f"""
    {LOST}, gone as (select game, min(ord) as since from lost where not found group by game)
    select c.game as game_id, count(*) as events_total, count(case when c.ord > g.since then 1 end) as events_unresolved
    from counted c left join gone g on g.game = c.game where event_type in ('purchase', 'error', 'view') or event_type = 'click' and miss >= 0 group by c.game""")
def lost_lineups(spark, sf):
    """Events that count for nobody because a lineup is not known, per game."""
    return lossy_tables(spark, sf).event_totals.where("events_total > 0")


@register("f14_rotation_starters", f"""
    with {LOG}, per as (select distinct game, period from log where period > 1), spot as (select per.*, p.place from per, (select unnest(range(10)) as place) p)
    select game as game_id, period, place % 2 + 1 as team, string_agg((split_part(game, '/', 2)::bigint * 20 + place + 110)::varchar, ',' order by place) as starters
    from spot group by all""")
def rotation_starters(spark, sf):
    """Starters of later periods as the rotation tells them, against a log that would say otherwise."""
    log, box = cut(id_log(spark, sf)), cut(box_score(spark, sf))
    bench = box.where("position = ''").select("game_id", "person_id", "team_id")
    spells = log.where("period > 1").select("game_id", "period").distinct().join(bench, "game_id").select(
        "game_id", F.col("person_id").alias("PERSON_ID"), F.col("team_id").alias("TEAM_ID"), ((F.col("period") - 1) * 7200.0).alias("IN_TIME_REAL"),
        (F.col("period") * 7200.0).alias("OUT_TIME_REAL"))
    s = derive_game_tables(box, id_log=log, rotation=cut(spells)).segments.where("seg_no = 0 AND period > 1")
    return s.select("game_id", "period", "team", F.array_join(F.transform(F.array_sort("players"), lambda p: p.cast("string")), ",").alias("starters"))


@register("f15_event_totals", f"""
    {FLOOR}, c as (select distinct game, ord from who where event_type <> 'click' or miss >= 0)
    select game as game_id, count(*) as events_total, 0::bigint as events_unresolved from c group by game""")
def event_totals(spark, sf):
    t = tables(spark, sf).event_totals
    return t.where("events_total > 0")


