"""Raw tables to one league. Count tables are united in long form and pivoted once, instead of being
joined one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions import scalars as sc
from tallywright.operators import lineups as lu
from tallywright.operators import models as md
from tallywright.operators import quality as q
from tallywright.operators.sequences import latest_per_column
from tallywright.plans import specs as sp
from tallywright.plans.game_log import GameTables, derive_game_tables
from tallywright.plans.lineage import cut
from tallywright.plans.profile import ID, League, union_all
from tallywright.sources.payloads import pick_columns, prefer_source, require_columns

# Columns read per source.
REQUIRED = {
    "player_base_totals": ["PLAYER_ID", "TEAM_ID", "GP", "MIN", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB",
        "DREB", "AST", "TOV", "STL", "BLK", "PF", "PTS"],
    "player_clutch_base": ["PLAYER_ID", "PTS", "FGA", "FTA"],
    "player_hustle": ["PLAYER_ID", "CONTESTED_SHOTS", "DEFLECTIONS", "CHARGES_DRAWN", "SCREEN_ASSISTS",
        "SCREEN_AST_PTS", "OFF_LOOSE_BALLS_RECOVERED", "DEF_LOOSE_BALLS_RECOVERED", "LOOSE_BALLS_RECOVERED",
        "OFF_BOXOUTS", "DEF_BOXOUTS"],
    "pt_Drives": ["PLAYER_ID", "DRIVES", "DRIVE_FGA", "DRIVE_PASSES", "DRIVE_FTA"],
    "pt_Passing": ["PLAYER_ID", "PASSES_MADE", "POTENTIAL_AST", "AST_ADJ", "FT_AST", "SECONDARY_AST",
        "AST_POINTS_CREATED"],
    "pt_Possessions": ["PLAYER_ID", "TOUCHES", "AVG_DRIB_PER_TOUCH"],
    "pt_Rebounding": ["PLAYER_ID", "OREB", "DREB", "OREB_CHANCES", "DREB_CHANCES", "OREB_CHANCE_DEFER",
        "DREB_CHANCE_DEFER"],
    "pt_SpeedDistance": ["PLAYER_ID", "MIN", "AVG_SPEED_OFF", "AVG_SPEED_DEF", "DIST_MILES_OFF", "DIST_MILES_DEF"],
    "pt_shot": ["PLAYER_ID", "general_range", "def_dist", "FGA", "FG3M", "FG3A"],
    "pt_shot_clock": ["PLAYER_ID", "clock_range", "FGA"],
    "synergy": ["PLAYER_ID", "side", "play_type", "POSS", "PTS"],
    "shot_chart": ["GAME_ID", "GAME_EVENT_ID", "PLAYER_ID", "TEAM_ID", "PERIOD", "MINUTES_REMAINING",
        "SECONDS_REMAINING", "ACTION_TYPE", "SHOT_TYPE", "SHOT_ZONE_BASIC", "SHOT_ZONE_AREA", "SHOT_DISTANCE",
        "LOC_X", "LOC_Y", "SHOT_ATTEMPTED_FLAG", "SHOT_MADE_FLAG", "GAME_DATE"],
    "roster": ["TeamID", "PLAYER_ID", "PLAYER", "NUM", "POSITION", "HEIGHT", "WEIGHT", "BIRTH_DATE", "AGE", "EXP"],
    "team_game_log": ["TEAM_ID", "GAME_ID", "GAME_DATE", "MATCHUP", "PTS"],
    "team_advanced_totals": ["TEAM_ID", "PACE"],
    "player_game_logs": ["PLAYER_ID", "GAME_ID", "GAME_DATE", "MIN", "PTS", "FGM", "FGA", "FTM", "FTA", "OREB",
        "DREB", "STL", "AST", "BLK", "PF", "TOV"],
    "combine_anthro": ["PLAYER_ID", "year", "WINGSPAN"],
    "combine_drills": ["PLAYER_ID", "year", *sp.COMBINE_TESTS],
    "box": ["game_id", "person_id", "team_id", "first_name", "family_name", "position", "comment", "minutes"],
    "inactive": ["game_id", "person_id", "team_id"],
    "player_index": ["PERSON_ID", "HEIGHT", "WEIGHT"],
    "contests": ["CLOSE_DEF_PERSON_ID"],
    "id_log": ["game_id", "actionNumber", "clock", "period", "teamId", "personId", "actionType", "subType"],
    "text_log": ["game_id", "actionNumber", "clock", "period", "teamId", "personId", "actionType", "subType",
        "description", "shotResult", "isFieldGoal"],
    "rotation": ["game_id", "PERSON_ID", "TEAM_ID", "IN_TIME_REAL", "OUT_TIME_REAL"],
}
REBOUND_CHANCES = ["OREB_CHANCES", "DREB_CHANCES", "OREB_CHANCE_DEFER", "DREB_CHANCE_DEFER"]
# Play types, late-clock buckets and contest column names.
PLAY_TYPES = ("Isolation", "PRBallHandler", "PRRollman", "Postup", "Spotup", "Handoff", "Cut", "OffScreen",
              "OffRebound", "Transition", "Misc")
LATE_CLOCK = ("7-4 Late", "4-0 Very Late")
CONTEST_COLUMNS = {
    "Overall": [("D_FGM", "D_FGA", "NORMAL_FG_PCT")],
    "P3": [("FG3M", "FG3A", "NS_FG3_PCT"), ("D_FGM", "D_FGA", "NORMAL_FG_PCT")],
    "P2ALL": [("FG2M", "FG2A", "NS_FG2_PCT"), ("D_FGM", "D_FGA", "NORMAL_FG_PCT")],
    "R": [("FGM_LT_06", "FGA_LT_06", "NS_LT_06_PCT"), ("D_FGM", "D_FGA", "NORMAL_FG_PCT")],
}
BOX_COUNTS = ("PTS", "FGM", "FGA", "FTM", "FTA", "OREB", "DREB", "STL", "AST", "BLK", "PF", "TOV")


def long_counts(df: DataFrame, columns: dict | list) -> DataFrame:
    """(player_id, stat, value) rows from one scan; ``columns`` pairs a stat (name or Column, NULL to
    leave the row out) with a column or expression."""
    pairs = columns.items() if isinstance(columns, dict) else columns
    cells = F.array(*[F.struct((F.lit(s) if isinstance(s, str) else s).alias("stat"),
                               sc.to_num(F.col(c) if isinstance(c, str) else c).alias("value")) for s, c in pairs])
    return df.select(F.col("PLAYER_ID").cast("bigint").alias(ID), F.explode(cells).alias("s")).select(
        ID, "s.stat", "s.value").where(F.col("stat").isNotNull() & F.col("value").isNotNull())


def _same(names: list[str]) -> dict:
    return {c: c for c in names if c not in ("PLAYER_ID", "TEAM_ID")}


def count_table(raw: dict, games: GameTables) -> DataFrame:
    """The wide input table: one row per player seen anywhere, missing counts 0."""
    speed = raw["pt_SpeedDistance"]
    minutes = sc.to_num("MIN")
    total = (F.col("def_dist").isNull()) | (F.col("def_dist") == "")
    offense = (F.col("side") == "offensive") & F.col("play_type").isin(*PLAY_TYPES)

    def play(kind):
        guarded = (F.col("side") != "offensive") & (F.col("play_type") == "Postup")
        return F.when(offense, F.concat(F.lit("SYN_"), F.col("play_type"), F.lit("_" + kind))).when(
            guarded, F.lit("SYN_D_Postup_" + kind))

    reb = {k: k for k in REBOUND_CHANCES if k in raw["pt_Rebounding"].columns}
    parts = [
        long_counts(raw["player_base_totals"], _same(REQUIRED["player_base_totals"])),
        long_counts(raw["pt_shot_clock"].where(F.col("clock_range").isin(*LATE_CLOCK)), {"LATE_CLOCK_FGA": "FGA"}),
        long_counts(raw["pt_shot"].where(total), [(F.when(F.col("general_range") == "Catch and Shoot", "CS_FGA").when(
            F.col("general_range") == "Pullups", "PU_FGA"), "FGA")]),
        long_counts(raw["pt_Drives"], _same(REQUIRED["pt_Drives"])),
        long_counts(raw["pt_Passing"], _same(REQUIRED["pt_Passing"])),
        long_counts(raw["pt_Possessions"], {"TOUCHES": "TOUCHES", "DRIBBLES": sc.to_num("TOUCHES") * sc.to_num(
            "AVG_DRIB_PER_TOUCH")}),
        long_counts(raw["pt_Rebounding"], {"TRK_OREB": "OREB", "TRK_DREB": "DREB", **reb}),
        long_counts(speed, {"SPEED_MIN": "MIN", "DIST_MILES_OFF": "DIST_MILES_OFF", "DIST_MILES_DEF": "DIST_MILES_DEF",
                            "SPEED_OFF_X_MIN": sc.to_num("AVG_SPEED_OFF") * minutes,
                            "SPEED_DEF_X_MIN": sc.to_num("AVG_SPEED_DEF") * minutes}),
        long_counts(raw["player_hustle"], _same(REQUIRED["player_hustle"])),
        long_counts(raw["synergy"], [(play("POSS"), "POSS"), (play("PTS"), "PTS"), (F.when(offense, "SYN_TOTAL_POSS"), "POSS")]),
        long_counts(raw["player_clutch_base"], {f"CLUTCH_{c}": c for c in ("PTS", "FGA", "FTA")}),
        games.on_floor.unpivot([ID], [*lu.TEAM_FIELDS, *lu.OPP_FIELDS], "stat", "value"),
        games.player_events.select(ID, F.col("field").alias("stat"), "value"),
    ]
    names = [*_same(REQUIRED["player_base_totals"]), "LATE_CLOCK_FGA", "CS_FGA", "PU_FGA",
             *_same(REQUIRED["pt_Drives"]), *_same(REQUIRED["pt_Passing"]), "TOUCHES", "DRIBBLES",
             "TRK_OREB", "TRK_DREB", *REBOUND_CHANCES, "SPEED_MIN", "DIST_MILES_OFF",
             "DIST_MILES_DEF", "SPEED_OFF_X_MIN", "SPEED_DEF_X_MIN", *_same(REQUIRED["player_hustle"]),
             *[f"SYN_{p}_{k}" for p in PLAY_TYPES for k in ("POSS", "PTS")], "SYN_TOTAL_POSS",
             "SYN_D_Postup_POSS", "SYN_D_Postup_PTS", *[f"CLUTCH_{c}" for c in ("PTS", "FGA", "FTA")],
             *lu.TEAM_FIELDS, *lu.OPP_FIELDS, *lu.PLAYER_FIELDS]
    wide = union_all(parts).groupBy(ID).pivot("stat", names).agg(F.sum("value")).na.fill(0.0)
    wide = wide.withColumn("AVG_SPEED_OFF", F.coalesce(sc.safe_div("SPEED_OFF_X_MIN", "SPEED_MIN"), F.lit(0.0)))
    wide = wide.withColumn("AVG_SPEED_DEF", F.coalesce(sc.safe_div("SPEED_DEF_X_MIN", "SPEED_MIN"), F.lit(0.0)))
    for side, out in (("team", "OFF_POSS"), ("opp", "DEF_POSS")):
        wide = wide.withColumn(out, sc.possessions(*[f"{side}_{c}" for c in ("fga", "oreb", "tov", "fta")]))
    return wide


def roster_table(raw: dict) -> DataFrame:
    r = raw["roster"]
    twice = q.repeated_keys(r, ["PLAYER_ID"]).limit(20).collect()
    if twice:
        raise ValueError(f"players on more than one roster: {[x['PLAYER_ID'] for x in twice]}")
    base = r.select(
        F.col("PLAYER_ID").cast("bigint").alias(ID), F.col("TeamID").cast("bigint").alias("team_id"),
        F.col("PLAYER").alias("display_name"), F.col("NUM").alias("jersey"),
        F.trim(F.coalesce("POSITION", F.lit(""))).alias("position"), F.col("BIRTH_DATE").alias("birth_date"),
        F.col("EXP").alias("experience"), sc.to_num("AGE").alias("age"), sc.height_inches("HEIGHT").alias("__h"),
        sc.to_num("WEIGHT").alias("__w"), *([F.col("roster_order")] if "roster_order" in r.columns else [
            F.lit(0).alias("roster_order")]))
    odd = q.unknown_labels(base, "position", list(sc.POSITION_AXIS)).limit(20).collect()
    if odd:
        raise ValueError(f"position labels outside the published seven: {[(x[ID], x['position']) for x in odd]}")
    if "player_index" in raw:
        second = raw["player_index"].select(F.col("PERSON_ID").cast("bigint").alias(ID), sc.height_inches("HEIGHT").alias(
            "__h2"), sc.to_num("WEIGHT").alias("__w2"))
        base = base.join(second, ID, "left")
    else:
        base = base.withColumn("__h2", F.lit(None).cast("double")).withColumn("__w2", F.lit(None).cast("double"))
    return base.withColumn("height_in", F.coalesce("__h", "__h2")).withColumn(
        "weight_lb", F.coalesce("__w", "__w2")).withColumn("position_index", sc.position_index("position")).drop(
        "__h", "__h2", "__w", "__w2")


def shot_table(chart: DataFrame) -> DataFrame:
    """Attempted shots, one per (game, event); of repeated rows the first in a total order stays."""
    tried = chart.where(sc.to_num("SHOT_ATTEMPTED_FLAG") == 1)

    def whole(c):
        return sc.to_num(c).cast("bigint")

    s = tried.select(
        F.col("GAME_ID").cast("string").alias("game_id"), whole("GAME_EVENT_ID").alias("event_id"),
        whole("PLAYER_ID").alias(ID), whole("TEAM_ID").alias("team_id"), whole("PERIOD").alias("period"),
        whole("MINUTES_REMAINING").alias("minutes_remaining"), whole("SECONDS_REMAINING").alias("seconds_remaining"),
        F.col("ACTION_TYPE").alias("action_type"), F.col("SHOT_TYPE").alias("shot_type"),
        F.col("SHOT_ZONE_BASIC").alias("zone"), F.col("SHOT_ZONE_AREA").alias("area"),
        sc.to_num("SHOT_DISTANCE").alias("distance"), sc.to_num("LOC_X").alias("x"), sc.to_num("LOC_Y").alias("y"),
        whole("SHOT_MADE_FLAG").alias("made"), F.col("GAME_DATE").cast("string").alias("game_date"))
    return q.first_per_key(s, ["game_id", "event_id"], ["team_id", ID, "period", "game_date"])


def contest_table(tables: dict) -> DataFrame:
    """Long contests (player_id, category, A, M, E); P2 = all twos minus rim, gaps 0."""
    parts = []
    for cat, options in CONTEST_COLUMNS.items():
        d = pick_columns(tables[cat], f"contests {cat}", options, ("m", "a", "q"))
        a = F.coalesce(sc.to_num("a"), F.lit(0.0))
        parts.append(d.select(F.col("CLOSE_DEF_PERSON_ID").cast("bigint").alias(ID), F.lit(cat).alias("cat"),
                              a.alias("A"), F.coalesce(sc.to_num("m"), F.lit(0.0)).alias("M"),
                              (F.coalesce(sc.to_num("q"), F.lit(0.0)) * a).alias("E")))
    rows = union_all(parts)

    def weight(target):
        if target == "P2":
            return F.when(F.col("cat") == "P2ALL", 1.0).when(F.col("cat") == "R", -1.0).otherwise(0.0)
        return F.when(F.col("cat") == target, 1.0).otherwise(0.0)

    cells = F.array(*[F.struct(F.lit(t).alias("category"), weight(t).alias("k")) for t in sp.CONTEST_CATEGORIES])
    spread = rows.select(ID, "A", "M", "E", F.explode(F.transform(cells, lambda c: c)).alias("c"))
    return spread.groupBy(ID, F.col("c.category").alias("category")).agg(
        *[F.sum(F.col("c.k") * F.col(v)).alias(v) for v in ("A", "M", "E")])


def contest_source_rows(tables: dict) -> DataFrame:
    """(entity_id, category, A) of the four source tables, for the consistency checks."""
    return union_all([pick_columns(tables[c], f"contests {c}", o, ("m", "a", "q")).select(
        F.col("CLOSE_DEF_PERSON_ID").cast("bigint").alias("entity_id"), F.lit(c).alias("category"),
        F.coalesce(sc.to_num("a"), F.lit(0.0)).alias("A")) for c, o in CONTEST_COLUMNS.items()])


def durability_table(box: DataFrame, inactive: DataFrame) -> DataFrame:
    """Roster games and missed games per player, counted once per (player, team, game)."""
    comment = F.trim(F.coalesce("comment", F.lit("")))
    choice = F.translate(F.lower(comment), "’", "'").contains("coach's decision")
    idle = (sc.minutes_value("minutes") == 0) & (comment != "")
    flags = box.select("game_id", "person_id", "team_id", (idle & ~choice).cast("int").alias("out")).unionByName(
        inactive.select("game_id", "person_id", "team_id", F.lit(1).alias("out")))
    per = flags.groupBy("person_id", "team_id", "game_id").agg(F.max("out").alias("out"))
    return per.groupBy(F.col("person_id").cast("bigint").alias(ID)).agg(
        F.count(F.lit(1)).cast("double").alias("roster_games"), F.sum("out").cast("double").alias("games_missed"))


def dnp_comments(box: DataFrame) -> DataFrame:
    comment = F.trim(F.coalesce("comment", F.lit("")))
    return box.where((sc.minutes_value("minutes") == 0) & (comment != "")).groupBy(comment.alias("comment")).agg(
        F.count(F.lit(1)).alias("n"))


def game_table(team_rows: DataFrame, homes: DataFrame) -> DataFrame:
    """One row per game from two team rows and the stated home and away teams (errors first)."""
    rows = team_rows.select(F.col("GAME_ID").cast("string").alias("game_id"), F.col("TEAM_ID").cast("bigint").alias("team"),
                            F.col("GAME_DATE").cast("string").alias("game_date"), sc.to_num("PTS").cast("int").alias("pts"))
    bad = q.game_pairs(rows, homes, "game_id", "team").limit(20).collect()
    if bad:
        raise ValueError("cannot build these games: " + "; ".join(f"{b['game_id']}: {b['problem']}" for b in bad))
    j = rows.join(homes, "game_id")
    return j.groupBy("game_id").agg(
        F.min("game_date").alias("game_date"), F.max("home").alias("home_team_id"), F.max("away").alias("away_team_id"),
        F.max(F.when(F.col("team") == F.col("home"), F.col("pts"))).alias("home_points"),
        F.max(F.when(F.col("team") == F.col("away"), F.col("pts"))).alias("away_points"))


def team_stat_rows(tables: dict) -> DataFrame:
    """(team_id, stat, value) of numeric team columns, ids and rank columns left out."""
    parts = []
    for prefix, df in tables.items():
        keep = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float") and not c.endswith("_RANK")
                and c not in ("TEAM_ID", "TEAM_NAME", "CFID", "CFPARAMS")]
        typed = df.select(F.col("TEAM_ID").cast("bigint").alias("team_id"), *[F.col(c).cast("double").alias(c) for c in keep])
        parts.append(typed.unpivot(["team_id"], keep, "stat", "value").withColumn(
            "stat", F.concat(F.lit(prefix + "."), F.col("stat"))))
    return q.first_per_key(union_all(parts), ["team_id", "stat"], ["value"])


def shot_cells(pt_shot: DataFrame) -> DataFrame:
    keep = F.col("general_range").isin("Catch and Shoot", "Pullups") & (F.coalesce("def_dist", F.lit("")) != "")
    return pt_shot.where(keep).groupBy(F.col("PLAYER_ID").cast("bigint").alias(ID), "general_range", "def_dist").agg(
        F.sum(sc.to_num("FG3M")).alias("FG3M"), F.sum(sc.to_num("FG3A")).alias("FG3A"))


def check_contracts(raw: dict) -> None:
    """Every source that is given has the columns read from it, or an error names the source and what it lacks."""
    for name, columns in REQUIRED.items():
        given = raw.get(name)
        if name == "pt_Rebounding":
            columns = columns[:3]  # the chance columns have a fallback
        for part, df in (given.items() if isinstance(given, dict) else [("", given)]):
            if df is not None:
                require_columns(df, f"{name} {part}".strip(), columns)
    if raw.get("seasons"):
        for name, df in zip(("box", "inactive"), raw["seasons"], strict=True):
            require_columns(df, f"seasons {name}", [c for c in REQUIRED[name] if c in ("game_id", "person_id", "team_id", "minutes", "comment")])


def assemble(raw: dict) -> League:
    """``raw``: DataFrames by source name (see REQUIRED), plus ``contests`` (four tables), ``homes``,
    ``seasons`` (box and inactive rows of the durability seasons) and the logs."""
    check_contracts(raw)
    games = derive_game_tables(raw["box"], raw.get("id_log"), raw.get("text_log"), raw.get("rotation"))
    inputs = cut(count_table(raw, games))
    shots = cut(shot_table(raw["shot_chart"]))
    roster = roster_table(raw)
    anthro = raw["combine_anthro"].select(F.col("PLAYER_ID").cast("bigint").alias(ID), "year", sc.to_num("WINGSPAN").alias(
        "wingspan_measured")).where(F.col(ID) > 0)
    drills = raw["combine_drills"].select(F.col("PLAYER_ID").cast("bigint").alias(ID), "year", *[
        sc.to_num(t).alias(t) for t in sp.COMBINE_TESTS]).where(F.col(ID) > 0)
    spans = latest_per_column(anthro, ID, ["year"], ["wingspan_measured"])
    combine = latest_per_column(drills, ID, ["year"], list(sp.COMBINE_TESTS))
    roster, wing = md.linear_imputation(roster.join(spans, ID, "left"), "height_in", "wingspan_measured", "wingspan_in",
                                        "wingspan_imputed")
    roster = cut(roster.drop("wingspan_measured"))
    logs = raw["player_game_logs"].select(
        F.col("PLAYER_ID").cast("bigint").alias(ID), F.col("GAME_ID").cast("string").alias("game_id"),
        F.col("GAME_DATE").cast("string").alias("game_date"), sc.minutes_value("MIN").alias("MIN"),
        *[F.coalesce(sc.to_num(c), F.lit(0.0)).alias(c) for c in BOX_COUNTS])
    minutes = raw["box"].withColumn("minutes", sc.minutes_value("minutes"))
    extra = {
        "games": game_table(raw["team_game_log"], raw["homes"]), "usage": lu.usage(minutes),
        "names": q.first_per_key(raw["box"].select(F.col("person_id").alias(ID), "first_name", "family_name", "game_id"),
                                 [ID], ["game_id"]).drop("game_id"),
        "team_stats": team_stat_rows({"base": raw["team_base_totals"], "advanced": raw["team_advanced_totals"]}),
        "game_tables": games, "wingspan_fit": wing, "teams": raw.get("teams"), "box_minutes": minutes,
    }
    boxes, idle = raw["seasons"]
    attempts = inputs.agg(F.sum("FGA")).first()[0] or 0.0
    matched = q.match_rate(games.shots.select("game_id", "event_id"), shots, ["game_id", "event_id"])
    comments = dnp_comments(boxes).agg(F.count(F.lit(1)).alias("n"))
    extra["checks"] = union_all([
        q.contest_checks(contest_source_rows(raw["contests"]), attempts),
        matched.select(F.lit("logged shots joined to the shot chart").alias("name"), "ok", F.col("rate").alias("detail")),
        comments.select(F.lit("box-score comments seen").alias("name"), (F.col("n") > 0).cast("int").alias("ok"),
                        F.col("n").cast("double").alias("detail"))])
    return League(
        roster=roster, inputs=inputs, shots=shots, pbp_shots=games.shots, assists=games.assists, stints=games.stints,
        stretch_minutes=games.stretch_minutes, contests=cut(contest_table(raw["contests"])), cells=shot_cells(raw["pt_shot"]),
        combine=combine, game_logs=logs, durability=durability_table(boxes, idle),
        team_pace=raw["team_advanced_totals"].select(F.col("TEAM_ID").cast("bigint").alias("team_id"), sc.to_num("PACE").alias("pace")),
        fouls=games.fouls, rebound_chances=all(
            c in raw["pt_Rebounding"].columns for c in REQUIRED["pt_Rebounding"]), extra=extra)


__all__ = ["assemble", "check_contracts", "prefer_source", "REQUIRED"]
