"""The shared tables read as a league, so the full derivation runs on them and grows with them.

A player is a (part size, part type) pair, a game an order, a shot a line item. Counts are sums over
line items joined to their part; the conditions compare quantity with part size, so players differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.catalogue.base import table
from tallywright.operators.lineups import OPP_FIELDS, PLAYER_FIELDS, TEAM_FIELDS
from tallywright.operators.quality import first_per_key
from tallywright.plans import specs as sp
from tallywright.plans.lineage import cut, together
from tallywright.plans.profile import Derivation, League, Profiles

# The part types in their numbering, and the labels derived from it.
TYPES = ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")
POSITIONS = ("G", "G-F", "F", "F-C", "C", "F-G")


def case(cond: str) -> str:
    return f"case when {cond} then 1.0 else 0.0 end"


# What one line item adds to each count. q quantity, s part size, n line number,
# d discount in percent, k tax in percent, rf return flag.
ROW_COUNTS = {
    "FGA": case("n <= 5"), "FGM": case("n <= 5 and q > s"),
    "FG3A": case("n <= 5 and q < s + 10"), "FG3M": case("n <= 5 and q < s + 10 and d > 5"),
    "FTA": case("n >= 4"), "FTM": case("n >= 4 and q + 10 > s"),
    "OREB": case("n = 6 and q > s"), "DREB": case("n = 7 and q > s"), "AST": case("d >= 7 and q > s"),
    "TOV": case("k >= 7"), "STL": case("d <= 1 and q > s"), "BLK": case("d = 2 and q > s"), "PF": case("k <= 1 and q > s"),
    "PTS": "case when n <= 5 and q > s then 2.0 when n >= 6 then 1.0 else 0.0 end",
    "LATE_CLOCK_FGA": case("n <= 5 and q + 20 < s"), "CS_FGA": case("n <= 3 and q < s"), "PU_FGA": case("n <= 3 and q >= s"),
    "DRIVES": case("n <= 3 and q > s - 5"), "DRIVE_FGA": case("n = 1 and q > s"), "DRIVE_PASSES": case("n <= 3 and q < s"),
    "DRIVE_FTA": case("n = 2 and q > s"),
    "PASSES_MADE": "1.0 + " + case("q > s"), "POTENTIAL_AST": case("d >= 5 and q > s"), "AST_ADJ": case("d >= 6 and q > s"),
    "AST_POINTS_CREATED": "2.0 * " + case("d >= 7 and q > s"), "DRIBBLES": "3.0 + " + case("q < s"),
    "TRK_OREB": case("n = 6 and q > s"), "TRK_DREB": case("n = 7 and q > s"), "OREB_CHANCES": case("n = 6 and q > s - 15"),
    "DREB_CHANCES": case("n = 7 and q > s - 15"), "OREB_CHANCE_DEFER": case("n = 6 and q > s - 15 and q <= s and d = 0"),
    "DREB_CHANCE_DEFER": case("n = 7 and q > s - 15 and q <= s and d = 0"),
    "SPEED_MIN": "2.0", "DIST_MILES_OFF": "0.1 + q / 1000.0", "DIST_MILES_DEF": "0.1 + s / 1000.0",
    "CONTESTED_SHOTS": case("n <= 4 and q > s"), "DEFLECTIONS": case("d <= 3 and q > s"),
    "CHARGES_DRAWN": case("d = 4 and q > s"), "SCREEN_ASSISTS": case("n = 3 and q > s"),
    "SCREEN_AST_PTS": "2.0 * " + case("n = 3 and q > s + 3"), "OFF_LOOSE_BALLS_RECOVERED": case("n = 1 and q > s + 5"),
    "DEF_LOOSE_BALLS_RECOVERED": case("n = 2 and q > s + 5"), "LOOSE_BALLS_RECOVERED": case("n <= 2 and q > s + 5"),
    "OFF_BOXOUTS": case("n = 4 and q > s"), "DEF_BOXOUTS": case("n = 5 and q > s"),
    "SYN_Isolation_POSS": case("n = 1 and q < s"), "SYN_Isolation_PTS": "2.0 * " + case("n = 1 and q < s and d > 4"),
    "SYN_PRBallHandler_POSS": case("n = 2 and q > s"), "SYN_PRBallHandler_PTS": "2.0 * " + case("n = 2 and q > s and d > 5"),
    "SYN_Postup_POSS": case("n = 3 and q > s"), "SYN_Postup_PTS": "2.0 * " + case("n = 3 and q > s + 12"),
    "SYN_Cut_POSS": case("n = 4 and q < s"), "SYN_Cut_PTS": "2.0 * " + case("n = 4 and q < s and d > 3"),
    "SYN_OffScreen_PTS": "2.0 * " + case("n = 5 and q < s and d > 3"),
    "SYN_Handoff_PTS": "2.0 * " + case("n = 6 and q < s and d > 3"), "SYN_Transition_POSS": case("n = 7 and q < s"),
    "SYN_TOTAL_POSS": "1.0", "SYN_D_Postup_POSS": case("n <= 2"), "SYN_D_Postup_PTS": "2.0 * " + case("n <= 2 and q > s"),
    "CLUTCH_PTS": "2.0 * " + case("n = 5 and q > s"), "CLUTCH_FGA": case("n = 5"), "CLUTCH_FTA": case("n = 5 and d > 8"),
    "team_fga": "5.0", "team_fgm": "2.0 + " + case("q > 25"), "team_missed_fga": "3.0 - " + case("q > 25"),
    "team_fta": "1.0", "team_oreb": "0.5 + " + case("n = 6"), "team_dreb": "1.0", "team_tov": "0.5",
    "opp_fga": "5.0", "opp_fg2a": "3.0", "opp_missed_fga": "2.5", "opp_fta": "1.0", "opp_oreb": "0.5", "opp_dreb": "1.0",
    "opp_tov": "0.5", "opp_missed_final_ft": "0.25",
    "pbp_blocks": case("d = 2 and q > s"), "pbp_blocks_R": case("d = 2 and q > s and n <= 3"),
    "pbp_blocks_P2": case("d = 2 and q > s and n in (4, 5)"), "pbp_blocks_P3": case("d = 2 and q > s and n >= 6"),
    "pbp_blocks_recovered": case("d = 2 and q > s + 9"), "shooting_fouls": case("k = 1 and q > s"),
    "offensive_fouls_drawn": case("d = 4 and q > s + 6"), "nonshooting_def_fouls": case("k = 0 and q > s"),
    "tov_handling": case("k >= 7 and q > s"), "tov_bad_pass": case("k = 8 and q < s"), "tov_decision": case("k = 7 and q < s"),
    "A_Overall": case("n <= 2 or q > s"), "M_Overall": case("n <= 2 and q > s + 5"), "E_Overall": "0.4375 * " + case("n <= 2 or q > s"),
    "A_P3": case("n <= 2"), "M_P3": case("n <= 2 and q > s + 8"), "E_P3": "0.375 * " + case("n <= 2"),
    "A_P2": case("n in (3, 4)"), "M_P2": case("n in (3, 4) and q > s + 4"), "E_P2": "0.4375 * " + case("n in (3, 4)"),
    "A_R": case("n in (5, 6)"), "M_R": case("n in (5, 6) and q > s"), "E_R": "0.5 * " + case("n in (5, 6)"),
    "roster_games": "1.0", "games_missed": case("q < s - 8"),
}

_INDEX = "case p_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(TYPES)) + f" else {len(TYPES)} end"
PLAYER = f"(cast(p_size as bigint) - 1) * 7 + {_INDEX}"
#: the size of a player, which need not move beside the number
SIZE = "cast(floor(player_id / 7) + 1 as int)"
LINES_SQL = (f"select l_orderkey, l_linenumber as n, l_quantity as q, p_size as s, cast(round(l_discount * 100) as int) as d, "
             f"cast(round(l_tax * 100) as int) as k, l_returnflag as rf, l_shipdate, l_partkey, l_suppkey, "
             f"{PLAYER} as player_id from lineitem join part on l_partkey = p_partkey")
POSS_SQL = ("team_fga - team_oreb + team_tov + 0.44 * team_fta as OFF_POSS",
            "opp_fga - opp_oreb + opp_tov + 0.44 * opp_fta as DEF_POSS")
INPUTS_SQL = ("select *, " + ", ".join(POSS_SQL) + " from (select player_id, "
              + ", ".join(f"cast(sum({e}) as double) as {c}" for c, e in ROW_COUNTS.items())
              + f" from ({LINES_SQL}) lines group by player_id) summed")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                   "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    j = item.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"),
                    F.col("p_size").alias("s"), F.round(F.col("l_discount") * 100).cast("int").alias("d"),
                    F.round(F.col("l_tax") * 100).cast("int").alias("k"), F.col("l_returnflag").alias("rf"), "l_shipdate",
                    "l_partkey", "l_suppkey", F.expr(PLAYER).alias("player_id"))


def inputs(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    counted = (lines(spark, sf_dir) if rows is None else rows).groupBy("player_id").agg(*[
        F.sum(F.expr(e)).cast("double").alias(c) for c, e in ROW_COUNTS.items()])
    return counted.selectExpr("*", *POSS_SQL)


def shots(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One shot per (order, line number); repeated keys keep one row in a total order.

    Rows are picked while they are narrow; texts are made of the picked ones.
    """
    # Action names by line number.
    actions = ("Driving Layup Shot", "Floating Jump Shot", "Driving Dunk Shot", "Dunk Shot", "Hook Shot", "Jump Shot",
               "Pullup Jump Shot")
    q = F.col("q")
    action = F.element_at(F.array(*[F.lit(a) for a in actions]), F.col("n"))
    zone = (F.when(q < 8, "Restricted Area").when(q < 16, "In The Paint (Non-RA)").when(q < 30, "Mid-Range")
            .otherwise("Above the Break 3"))
    rows = lines(spark, sf_dir) if rows is None else rows
    narrow = rows.select("l_orderkey", "n", "player_id", "q", "d", "k", "rf", F.to_date("l_shipdate").alias("day"), "l_partkey", "l_suppkey",
                         F.floor(q / 2).alias("far"))
    return first_per_key(narrow, ["l_orderkey", "n"], ["day", "l_partkey", "l_suppkey", "far", "k"]).withColumn("s", F.expr(SIZE)).select(
        F.col("l_orderkey").cast("string").alias("game_id"), F.col("n").cast("bigint").alias("event_id"), "player_id",
        (F.col("player_id") % 30 + 1).alias("team_id"), (F.col("n") % 4 + 1).cast("bigint").alias("period"),
        (F.col("s") % 12).cast("bigint").alias("minutes_remaining"), (F.col("d") * 5).cast("bigint").alias("seconds_remaining"),
        action.alias("action_type"), F.when(q >= 30, "3PT Field Goal").otherwise("2PT Field Goal").alias("shot_type"),
        zone.alias("zone"), F.col("rf").alias("area"), F.col("far").cast("double").alias("distance"),
        (F.col("k") * 10).cast("double").alias("x"), q.alias("y"),
        ((F.col("q") + F.col("d") * 4) > F.col("s")).cast("bigint").alias("made"),
        F.date_format("day", "yyyy-MM-dd").alias("game_date"))


def league(spark: SparkSession, sf_dir: str) -> League:
    rows = cut(lines(spark, sf_dir))  # joined once, read by every table of the league
    # nearly every row is a box group of its own: rows move narrow, and are summed where they arrive
    boxes = rows.select("player_id", "l_orderkey", "l_shipdate", "n", "q", "d", "k").repartition("player_id", "l_orderkey").withColumn("s", F.expr(SIZE)).groupBy(
        "player_id", "l_orderkey").agg(
        *[F.sum(F.expr(ROW_COUNTS[c])).cast("double").alias(c) for c in (
            "PTS", "FGM", "FGA", "FTM", "FTA", "OREB", "DREB", "STL", "AST", "BLK", "PF", "TOV")],
        F.sum(F.lit(5.0) + F.col("q")).alias("MIN"), F.min("l_shipdate").cast("string").alias("game_date")).withColumn(
        "l_orderkey", F.col("l_orderkey").cast("string")).withColumnRenamed("l_orderkey", "game_id")
    wide, chart, box = together(lambda: cut(inputs(spark, sf_dir, rows)), lambda: cut(shots(spark, sf_dir, rows)), lambda: cut(boxes))
    size = (F.floor(F.col("player_id") / 7) + 1).cast("double")
    kind = (F.col("player_id") % 7).cast("int")
    label = F.element_at(F.array(*[F.lit(p) for p in (*POSITIONS, "C-F")]), kind + 1)
    hashed = F.pmod(F.xxhash64("player_id"), F.lit(97)).cast("double")
    roster = wide.select("player_id").select(
        "player_id", (F.col("player_id") % 30 + 1).alias("team_id"),
        F.concat(F.lit("Size "), size.cast("int").cast("string"), F.lit(" "), label).alias("display_name"),
        label.alias("position"), (kind + 1).alias("jersey"), F.lit(None).cast("string").alias("birth_date"),
        F.lit(None).cast("string").alias("experience"), (19 + hashed / 6).alias("age"), (70 + size / 4 + hashed / 40).alias("height_in"),
        (170 + size + hashed / 4).alias("weight_lb"), (72 + size / 4 + hashed / 30).alias("wingspan_in"),
        F.lit(0).alias("wingspan_imputed"), F.col("player_id").alias("roster_order"))
    from tallywright.functions.scalars import position_index
    roster = cut(roster.withColumn("position_index", position_index("position")))
    # ten-man stints: an order's line item against the next sizes and types on both sides
    off = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.pmod(F.col("player_id") + i * 11, F.lit(350)))
    de = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.pmod(F.col("player_id") * 3 + F.col("n") * 17 + i * 29 + 5, F.lit(350)))
    stints = rows.groupBy("l_orderkey", "player_id", "n").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.when(F.col("q") > F.col("s"), 2.0).otherwise(0.0)).alias("pts")).select(
        F.col("l_orderkey").cast("string").alias("game_id"), F.lit(1).alias("period"),
        (F.col("player_id") * 10 + F.col("n")).alias("span_from"), (F.col("player_id") % 30 + 1).alias("offense_team"),
        F.array_sort(off).alias("offense"), F.array_sort(de).alias("defense"), (F.col("c") * 2.0).alias("poss"), "pts",
        F.array(F.col("n").cast("bigint")).alias("shot_ids"))
    who = roster.select("player_id")
    # numbers that the size range leaves out stay out of the lineups' fits
    contests = wide.select("player_id", F.explode(F.array(*[F.struct(
        F.lit(c).alias("category"), *[F.col(f"{k}_{c}").alias(k) for k in ("A", "M", "E")]) for c in sp.CONTEST_CATEGORIES])).alias(
        "c")).select("player_id", "c.*")
    dist = F.element_at(F.array(*[F.lit(v) for v in ("0-2", "2-4", "4-6", "6+")]), F.col("n") % 4 + 1)
    cells = rows.groupBy("player_id", F.when(F.col("q") < F.col("s"), "Catch and Shoot").otherwise("Pullups").alias("general_range"),
                         dist.alias("def_dist")).agg(F.sum(F.when(F.col("d") > 5, 1.0).otherwise(0.0)).alias("FG3M"),
                                                     F.count(F.lit(1)).cast("double").alias("FG3A"))
    timed = chart.select("game_id", "event_id", F.col("player_id").alias("shooter"),
                         (F.col("seconds_remaining") / 10 + F.col("minutes_remaining")).cast("double").alias("minutes_on"))
    helped = chart.where("made = 1").select("game_id", "event_id", F.pmod(
        F.col("player_id") + F.col("event_id") * 7, F.lit(350)).alias("assister"), F.col("player_id").alias("shooter"))
    drills = roster.select("player_id", *[F.when(hashed % 4 != i % 4, 3.0 + i + size / (10.0 + i) + hashed / 50).alias(t)
                                          for i, t in enumerate(sp.COMBINE_TESTS)])
    return League(
        roster=roster, inputs=wide.select("player_id", *[c for c in wide.columns if c not in (
            "player_id", "roster_games", "games_missed") and c[:2] not in ("A_", "M_", "E_")],
            F.expr("2.5 + DIST_MILES_OFF / SPEED_MIN").alias("AVG_SPEED_OFF"),
            F.expr("2.0 + DIST_MILES_DEF / SPEED_MIN").alias("AVG_SPEED_DEF")),
        shots=chart, pbp_shots=timed, assists=helped, stints=stints,
        stretch_minutes=rows.select("player_id", (F.col("q") / 5 + F.col("s") / 10).alias("minutes")), contests=contests, cells=cells,
        combine=drills, game_logs=box, durability=wide.select("player_id", "roster_games", "games_missed"),
        team_pace=who.select((F.col("player_id") % 30 + 1).alias("team_id")).distinct().withColumn(
            "pace", 95 + (F.col("team_id") % 7).cast("double")),
        fouls=wide.agg(F.sum("shooting_fouls").alias("shooting_fouls"), (F.sum("shooting_fouls") * 1.4).alias("shooting_foul_ft_points")))


_done: dict = {}
_views: dict = {}


def profiles(spark: SparkSession, sf_dir: str, models: bool = True) -> tuple[Derivation, Profiles]:
    """The whole derivation, once per session and data folder; its tables are checkpointed."""
    app = spark.sparkContext.applicationId
    for key in ((app, sf_dir, models), (app, sf_dir, True)):
        if key in _done:
            return _done[key]
    if (app, sf_dir) not in _views:
        _views[(app, sf_dir)] = league(spark, sf_dir)
    d = Derivation(_views[(app, sf_dir)], models)
    _done[(app, sf_dir, models)] = (d, d.run())
    return _done[(app, sf_dir, models)]


__all__ = ["INPUTS_SQL", "LINES_SQL", "inputs", "lines", "shots", "league", "profiles", "OPP_FIELDS", "PLAYER_FIELDS",
           "TEAM_FIELDS"]
