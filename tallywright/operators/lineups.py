"""Who was on the floor, and everything counted against them.

A log is reduced to what concerns a team: its substitutions, acts that prove presence, and mentions of its players. ``recovery`` turns
these rows of one team in one game into segments (who is on from which event), in time linear in them. All counting is joins,
running states and grouped sums over the segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions.scalars import (is_regular_free_throw, is_reboundable_final_ft, period_end,
                                           period_start, possessions, shot_category, turnover_class)
from tallywright.operators.events import proves_presence
from tallywright.operators.ordered import Cuts, ordered_scan
from tallywright.operators.recovery import Moment, Row, TeamFloor
from tallywright.plans.lineage import cut

# Counted fields.
TEAM_FIELDS = ("team_fga", "team_fgm", "team_missed_fga", "team_fta", "team_oreb", "team_dreb", "team_tov")
OPP_FIELDS = ("opp_fga", "opp_fg2a", "opp_missed_fga", "opp_fta", "opp_oreb", "opp_dreb", "opp_tov",
              "opp_missed_final_ft")
PLAYER_FIELDS = ("pbp_blocks", "pbp_blocks_R", "pbp_blocks_P2", "pbp_blocks_P3", "pbp_blocks_recovered",
                 "shooting_fouls", "offensive_fouls_drawn", "nonshooting_def_fouls", "tov_handling",
                 "tov_bad_pass", "tov_decision")
LINEUP = 5

SEGMENT_SCHEMA = ("game_id string, period int, team bigint, seg_no int, ord_from bigint, t_from int, "
                  "t_floor int, players array<bigint>, exact boolean, note string, detail string")


def rotation_starters(rotation: DataFrame, periods: DataFrame) -> DataFrame:
    """(game, period, team) -> the five on at the period's start, where exactly five are."""
    ps = period_start("period")
    on = rotation.join(periods, "game_id").where((F.col("t_in") - 1 <= ps) & (ps < F.col("t_out") - 1))
    return on.groupBy("game_id", "period", "team").agg(F.collect_list("player_id").alias("players")).where(
        F.size("players") == LINEUP)


def team_rows(evs: DataFrame, rosters: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Rows that concern each team, with the running clock and the next event of either side.

    A person mentioned under the other team concerns their own team too.
    """
    timed = ordered_scan(evs.select("game_id", "period", "ord", "t", "kind", "team", "person", "sub", "outs", "ins", "in_name", "in_ids"),
                         ["game_id", "period"], ["ord"], {"t_floor": ("max", "t")}, cuts)
    timed = timed.withColumn("back", -F.col("ord")).withColumn("at", F.struct("ord", "t", "t_floor"))
    timed = ordered_scan(timed, ["game_id", "period"], ["back"], {"after": ("last_before", "at")}, mirrored(cuts))
    j = timed.join(rosters.select("game_id", "roster"), "game_id")
    home = F.try_element_at("roster", F.col("person"))["team"]
    j = j.withColumn("side", F.explode(F.array_distinct(F.array_compact(F.array("team", home)))))
    mine = F.col("team").eqNullSafe(F.col("side"))
    swap = mine & (F.col("kind") == "sub")
    acts = mine & proves_presence() & (home == F.col("side"))
    return j.where(swap | acts | F.col("person").isNotNull()).select(
        "game_id", F.col("side").alias("team"), "period", "at", "after", swap.alias("swap"), "outs", "ins", F.col("in_name").isNotNull().alias("named"),
        "in_ids", F.when(acts, F.col("person")).alias("actor"), F.col("person").alias("shown"))


def mirrored(cuts: Cuts | None) -> Cuts | None:
    """The same cuts for the falling order of a numeric column."""
    return None if cuts is None else Cuts(cuts.hot, tuple(sorted(1 - p for p in cuts.points)), cuts.skip)


def lineup_segments(evs: DataFrame, rosters: DataFrame, rotation: DataFrame | None = None, cuts: Cuts | None = None) -> DataFrame:
    """Segments per (game, period, team) plus note rows (``note`` not NULL). ``evs`` carries ``in_ids`` (name candidates) beside the
    event columns.

    A period opens with the five starters of the box score (the first one only), else the five of the rotation, else what the log shows.
    """
    periods = evs.groupBy("game_id", "period").agg(F.min(F.struct("ord", "t")).alias("first"))
    base = periods.join(rosters.select("game_id", "roster", F.explode("teams").alias("team")), "game_id")
    members = F.filter(F.map_values("roster"), lambda m: m["team"] == F.col("team"))
    box = F.transform(F.filter(members, lambda m: m["starts"]), lambda m: m["id"])
    base = base.withColumn("box", F.when((F.col("period") == 1) & (F.size(box) == LINEUP), box))
    if rotation is None:
        base = base.withColumn("spun", F.lit(None).cast("array<bigint>"))
    else:
        fives = rotation_starters(rotation, periods.select("game_id", "period"))
        base = base.join(fives.withColumnRenamed("players", "spun"), ["game_id", "period", "team"], "left")
    info = cut(base.groupBy("game_id", "team").agg(
        F.first(F.transform(members, lambda m: m["id"])).alias("members"),
        F.array_sort(F.collect_list(F.struct("period", period_start("period").alias("start"), "first", F.coalesce("box", "spun").alias("five")))).alias("periods")))
    rows = team_rows(evs, rosters, cuts)
    # what is told of a team in a game comes first, its rows follow in order: a task reads its team games one after another
    both = rows.select("*", F.lit(True).alias("listed")).unionByName(info.select("*", F.lit(False).alias("listed")), allowMissingColumns=True)
    keys = ["game_id", "team"]
    return both.repartition(*keys).sortWithinPartitions(*keys, "listed", "at.ord").mapInArrow(_team_games, SEGMENT_SCHEMA)


_SEGMENT_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
_SEGMENTS = pa.schema([(c.split()[0], _SEGMENT_TYPES[c.split()[1]]) for c in SEGMENT_SCHEMA.split(", ")])
_ROWS_OUT = 10_000


def _team_games(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(_SEGMENTS.types)], schema=_SEGMENTS)

    for key, rows in groupby((r for b in batches for r in b.to_pylist()), key=lambda r: (r["game_id"], r["team"])):
        told = next(rows)
        if not told["listed"]:
            made += _team_game(key, rows, told)
        if len(made) >= _ROWS_OUT:
            yield batch()
            made = []
    if made:
        yield batch()


def _team_game(key: tuple, rows: Iterator[dict], told: dict) -> list[tuple]:
    floor = TeamFloor({int(p) for p in told["members"]})
    by_period: dict[int, list] = {}
    for r in rows:
        after = r["after"]
        by_period.setdefault(int(r["period"]), []).append(Row(
            Moment(*map(int, (r["at"]["ord"], r["at"]["t"], r["at"]["t_floor"]))),
            None if after is None else Moment(*map(int, (after["ord"], after["t"], after["t_floor"]))), bool(r["swap"]),
            *([int(p) for p in (r[c] if r[c] is not None else ())] for c in ("outs", "ins")), bool(r["named"]),
            [int(p) for p in (r["in_ids"] if r["in_ids"] is not None else ())], r["actor"], r["shown"]))
    for p in told["periods"]:
        start, first = int(p["start"]), p["first"]
        here = by_period.get(int(p["period"]), [])
        here = [Row(Moment(r.at.ord, r.at.t, max(start, r.at.floor)), r.after and Moment(r.after.ord, r.after.t, max(start, r.after.floor)), *list(vars(r).values())[2:])
                for r in here]
        opening = Moment(int(first["ord"]), int(first["t"]), max(start, int(first["t"])))
        floor.play(int(p["period"]), start, opening, here, None if p["five"] is None else {int(x) for x in p["five"]})
    made = [(key[0], period, int(key[1]), *rest, None, None) for period, *rest in floor.segments]
    made += [(key[0], period, None, None, None, None, None, None, None, note, detail) for period, note, detail in floor.notes]
    return made


def segments_only(walked: DataFrame) -> DataFrame:
    return walked.where(F.col("note").isNull()).drop("note", "detail")


def notes_only(walked: DataFrame) -> DataFrame:
    return walked.where(F.col("note").isNotNull()).select("game_id", "period", "note", "detail")


# ------------------------------------------------------------------ time on the floor
def timed_segments(segments: DataFrame) -> DataFrame:
    """Segments with their end: next segment of the team in the period, or the period's end."""
    w = W.partitionBy("game_id", "period", "team").orderBy("seg_no")
    end = period_end("period")
    return segments.select(
        "*", F.coalesce(F.lead("t_from").over(w), end).alias("t_to"),
        F.coalesce(F.lead("t_floor").over(w), end).alias("t_floor_to"),
        F.coalesce(F.lead("exact").over(w), F.lit(True)).alias("exact_out"),
        F.lead("ord_from").over(w).alias("ord_to"))


def seconds_on(segments: DataFrame) -> DataFrame:
    timed = timed_segments(segments).where(F.size("players") == LINEUP)
    return timed.select("game_id", F.explode("players").alias("player_id"),
                        ((F.col("t_floor_to") - F.col("t_floor")) / 10.0).alias("s")).groupBy(
        "game_id", "player_id").agg(F.sum("s").alias("seconds"))


def stretches(segments: DataFrame) -> DataFrame:
    """Continuous stretches per player and period, with whether both ends are known exactly."""
    on = timed_segments(segments).where(F.col("players").isNotNull()).select(
        "*", F.explode("players").alias("player_id"))
    w = W.partitionBy("game_id", "period", "team", "player_id").orderBy("seg_no")
    islands = on.withColumn("__island", F.col("seg_no") - F.row_number().over(w))
    return islands.groupBy("game_id", "period", "team", "player_id", "__island").agg(
        F.min("ord_from").alias("ord_in"), F.min_by("t_from", "seg_no").alias("t_in"),
        F.min_by("exact", "seg_no").alias("exact_in"), F.max_by("t_to", "seg_no").alias("t_out"),
        F.max_by("exact_out", "seg_no").alias("exact_out"),
        F.max_by(F.struct("ord_to"), "seg_no")["ord_to"].alias("ord_out")).drop("__island")


def stretch_minutes(stretch: DataFrame) -> DataFrame:
    return stretch.where(F.col("exact_in") & F.col("exact_out")).select(
        "game_id", "player_id", ((F.col("t_out") - F.col("t_in")) / 600.0).alias("minutes"))


# ------------------------------------------------------------------ ten-man stints
def ten_man_spans(segments: DataFrame, rosters: DataFrame) -> DataFrame:
    """Spans between lineup changes of either team: (game, period, span_from, t0, t1, low, high)."""
    teams = rosters.select("game_id", F.col("teams")[0].alias("team_low"), F.col("teams")[1].alias("team_high"))
    j = segments.join(teams, "game_id")
    low = F.col("team") == F.col("team_low")
    # a change that loses and regains a lineup at one event leaves the regained one in force
    marks = j.groupBy("game_id", "period", "ord_from", "team_low", "team_high").agg(
        F.max_by(F.struct("players"), F.when(low, F.col("seg_no"))).alias("low"),
        F.max_by(F.struct("players"), F.when(~low, F.col("seg_no"))).alias("high"),
        F.max("t_from").alias("t0"))
    filled = ordered_scan(marks, ["game_id", "period"], ["ord_from"],
                          {"low_now": ("last", "low"), "high_now": ("last", "high")})
    w = W.partitionBy("game_id", "period").orderBy("ord_from")
    spans = filled.select(
        "game_id", "period", F.col("ord_from").alias("span_from"), "t0", "team_low", "team_high",
        F.coalesce(F.lead("t0").over(w), period_end("period")).alias("t1"),
        F.col("low_now.players").alias("low"), F.col("high_now.players").alias("high"))
    return spans.withColumn("valid", (F.coalesce(F.size("low"), F.lit(0)) == LINEUP)
                            & (F.coalesce(F.size("high"), F.lit(0)) == LINEUP))


def attach_spans(evs: DataFrame, spans: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """As-of join: each event gets the span in force, by one ordered pass over the united rows."""
    marks = spans.select("game_id", "period", F.col("span_from").alias("ord"), F.lit(0).alias("__rank"),
                         F.struct("span_from", "valid", "team_low", "team_high").alias("__span"))
    rows = evs.withColumn("__rank", F.lit(1))
    both = rows.unionByName(marks, allowMissingColumns=True)
    seen = ordered_scan(both, ["game_id", "period"], ["ord", "__rank"], {"__in": ("last", "__span")}, cuts)
    return seen.where(F.col("__rank") == 1).select(
        *evs.columns, F.col("__in.span_from").alias("span_from"), F.col("__in.valid").alias("valid"),
        F.when(F.col("team") == F.col("__in.team_low"), F.col("__in.team_high")).when(
            F.col("team") == F.col("__in.team_high"), F.col("__in.team_low")).alias("other"),
        (F.col("team") == F.col("__in.team_low")).alias("is_low"))


# ------------------------------------------------------------------ state before each event
def with_state(evs: DataFrame, rosters: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Add what was true just before each event: team in possession, team of the last live miss,
    pending block, pending shooting foul. ``evs`` has ``other`` and ``is_low``."""
    j = evs.join(rosters.select("game_id", "teams", "roster"), "game_id")

    def member(c):
        return F.try_element_at("roster", F.col(c))

    j = j.select(*evs.columns, "teams",
                 member("person")["team"].alias("person_team"),
                 F.coalesce(member("person")["played"], F.lit(False)).alias("person_played"),
                 member("blocker")["team"].alias("blocker_team"), member("drawn")["team"].alias("drawn_team"),
                 member("assist")["team"].alias("assist_team"))
    kind, team, other, made = (F.col(c) for c in ("kind", "team", "other", "made"))
    live = team.isNotNull()
    explicit = F.when(F.array_contains("teams", F.col("possession")), F.col("possession"))
    implied = (F.when(live & (kind == "fga"), F.when(made, other).otherwise(team))
               .when(live & (kind == "reb"), team).when(live & (kind == "tov"), other))
    miss = F.when(live & kind.isin("fga", "fta", "reb", "tov"),
                  F.struct(F.when(kind.isin("fga", "fta") & ~made, team).alias("team")))
    block = (F.when(live & (kind == "fga") & ~made,
                    F.struct(F.when(F.col("blocker_team").isNotNull(), F.col("blocker")).alias("by"),
                             F.col("blocker_team").alias("team")))
             .when(live & (kind == "reb"), F.struct(F.lit(None).cast("bigint").alias("by"),
                                                    F.lit(None).cast("bigint").alias("team"))))
    shooting = (live & (kind == "foul") & F.col("person_team").isNotNull() & F.col("sub").contains("shooting")
                & ~F.col("sub").contains("technical"))
    foul = F.when(shooting, F.struct(F.col("ord").alias("at"), other.alias("team")))
    final_ft = live & (kind == "fta") & is_regular_free_throw("sub") & (F.col("ft_n") == F.col("ft_of"))
    low = F.col("is_low")
    ord_ = F.col("ord")
    out = ordered_scan(j, ["game_id", "period"], ["ord"], {
        "__poss": ("last_before", F.coalesce(implied, explicit)),
        "__miss": ("last_before", miss), "__block": ("last_before", block), "__foul": ("last_before", foul),
        "__shot_low": ("last_before", F.when(live & (kind == "fga") & low, ord_)),
        "__shot_high": ("last_before", F.when(live & (kind == "fga") & ~low, ord_)),
        "__ft_low": ("last_before", F.when(final_ft & low, ord_)),
        "__ft_high": ("last_before", F.when(final_ft & ~low, ord_)),
    }, cuts)
    since = F.col("__foul.at")
    rival_shot = F.when(low, F.col("__shot_high")).otherwise(F.col("__shot_low"))
    own_final = F.when(low, F.col("__ft_low")).otherwise(F.col("__ft_high"))
    pending = ((F.col("__foul.team") == team) & (F.coalesce(rival_shot, F.lit(-1)) < since)
               & (F.coalesce(own_final, F.lit(-1)) < since))
    return out.select(
        *[c for c in j.columns if c != "teams"],
        F.coalesce(explicit, F.col("__poss")).alias("possession_before"),
        F.col("__miss.team").alias("miss_team"), F.col("__block.by").alias("block_by"),
        F.col("__block.team").alias("block_team"), F.coalesce(pending, F.lit(False)).alias("foul_pending"))


def _one(condition):
    return F.when(condition, 1.0)


def event_fields(evs: DataFrame) -> DataFrame:
    """Team-level facts of each event as 0/1 columns (NULL = 0), for grouped sums."""
    kind, made, team = F.col("kind"), F.col("made"), F.col("team")
    fga, fta, reb, tov = (kind == k for k in ("fga", "fta", "reb", "tov"))
    grabbed = reb & F.col("person_played") & F.col("miss_team").isNotNull()
    own = team == F.col("miss_team")
    return evs.where(team.isNotNull()).select(
        "*", _one(fga).alias("f_fga"), _one(fga & made).alias("f_fgm"), _one(fga & ~made).alias("f_missed_fga"),
        _one(fga & (F.col("value") == 2)).alias("f_fg2a"), _one(fta).alias("f_fta"),
        _one(grabbed & own).alias("f_oreb"), _one(grabbed & ~own).alias("f_dreb"), _one(tov).alias("f_tov"),
        _one(fta & ~made & is_reboundable_final_ft("sub")).alias("f_missed_final_ft"),
        _one(fga & (F.col("distance") < 6)).alias("f_rim_fga"),
        F.when(fga & made, F.col("value").cast("double")).when(fta & made, 1.0).alias("f_pts"))


def _total(c):
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(c[2:])


_SUMS = ("f_fga", "f_fgm", "f_missed_fga", "f_fg2a", "f_fta", "f_oreb", "f_dreb", "f_tov", "f_missed_final_ft",
         "f_rim_fga", "f_pts")


def span_totals(fields: DataFrame) -> DataFrame:
    """Counts per (span, team): the pre-aggregate every on-floor count is built from."""
    return fields.where("valid").groupBy("game_id", "period", "span_from", "team", "other").agg(
        *[_total(c) for c in _SUMS],
        F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "fga", F.struct("ord", "event_id")))),
                    lambda s: s["event_id"]).alias("shot_ids"))


def on_floor_counts(totals: DataFrame, spans: DataFrame, by: tuple = ()) -> DataFrame:
    """(player, team) sums of the 15 on-floor fields. Spans are exploded to players after the
    counts were summed, so ten rows per span and team move instead of ten per event."""
    lineups = spans.where("valid").select("game_id", "period", "span_from", "team_low", "low", "high")
    j = totals.join(lineups, ["game_id", "period", "span_from"])
    is_low = F.col("team") == F.col("team_low")
    own = j.select(*by, F.explode(F.when(is_low, F.col("low")).otherwise(F.col("high"))).alias("player_id"),
                   F.col("team").alias("team_id"),
                   *[F.col(f[5:]).alias(f) for f in TEAM_FIELDS], *[F.lit(0.0).alias(f) for f in OPP_FIELDS])
    faced = j.select(*by, F.explode(F.when(is_low, F.col("high")).otherwise(F.col("low"))).alias("player_id"),
                     F.col("other").alias("team_id"),
                     *[F.lit(0.0).alias(f) for f in TEAM_FIELDS], *[F.col(f[4:]).alias(f) for f in OPP_FIELDS])
    return own.unionByName(faced).groupBy(*by, "player_id", "team_id").agg(
        *[F.sum(f).alias(f) for f in (*TEAM_FIELDS, *OPP_FIELDS)])


def stint_rows(totals: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per (kept span, team on offense): lineups, possessions, points, shot ids.

    A span is kept if it has length or any counted event.
    """
    both = spans.where("valid").select("game_id", "period", "span_from", "t0", "t1", F.explode(F.array(
        F.struct(F.col("team_low").alias("team"), F.col("low").alias("offense"), F.col("high").alias("defense")),
        F.struct(F.col("team_high").alias("team"), F.col("high").alias("offense"), F.col("low").alias("defense"))
    )).alias("s")).select("game_id", "period", "span_from", "t0", "t1", "s.*")
    keys = ["game_id", "period", "span_from"]
    counted = F.col("fga") + F.col("fta") + F.col("oreb") + F.col("tov") > 0
    live = totals.where(counted).select(*keys).distinct().withColumn("__any", F.lit(True))
    j = both.join(totals, [*keys, "team"], "left").join(live, keys, "left")
    kept = j.where((F.col("t1") > F.col("t0")) | F.col("__any"))
    zero = F.lit(0.0)
    return kept.select(
        "game_id", "period", "span_from", F.col("team").alias("offense_team"), "offense", "defense", "t0", "t1",
        possessions(*[F.coalesce(c, zero) for c in ("fga", "oreb", "tov", "fta")]).alias("poss"),
        F.coalesce("pts", zero).alias("pts"), F.coalesce("fga", zero).alias("fga"),
        F.coalesce("fta", zero).alias("fta"),
        F.coalesce("shot_ids", F.array().cast("array<bigint>")).alias("shot_ids"))


def event_totals(fields: DataFrame) -> DataFrame:
    """Counted events and those without two known lineups."""
    counted = F.coalesce(*[F.col(c) for c in ("f_fga", "f_fta", "f_oreb", "f_dreb", "f_tov")]).isNotNull()
    ok = F.coalesce("valid", F.lit(False))
    return fields.groupBy("game_id").agg(F.count(F.when(counted, 1)).alias("events_total"),
                                         F.count(F.when(counted & ~ok, 1)).alias("events_unresolved"))


def player_event_counts(evs: DataFrame) -> DataFrame:
    """(player, field, value) counts of what players did, from events with state."""
    live = F.col("team").isNotNull()
    kind, sub, team = F.col("kind"), F.col("sub"), F.col("team")
    actor = F.col("person_team").isNotNull()
    blocked = live & (kind == "fga") & ~F.col("made") & F.col("blocker_team").isNotNull()
    foul = live & (kind == "foul") & actor & ~sub.contains("technical")
    shooting = foul & sub.contains("shooting")
    offensive = foul & ~shooting & (sub.contains("offensive") | sub.contains("charge"))
    defending = (foul & ~shooting & ~offensive & F.col("possession_before").isNotNull()
                 & (F.col("possession_before") != team))
    lost = live & (kind == "tov") & F.col("person_played")
    recovered = live & (kind == "reb") & (F.col("block_team") == team)

    def fact(condition, who, field):
        return F.when(condition, F.struct(F.col(who).alias("player_id"), field.alias("field")))

    facts = F.array(
        fact(blocked, "blocker", F.lit("pbp_blocks")),
        fact(blocked, "blocker", F.concat(F.lit("pbp_blocks_"), shot_category("value", "distance"))),
        fact(recovered, "block_by", F.lit("pbp_blocks_recovered")),
        fact(shooting, "person", F.lit("shooting_fouls")),
        fact(offensive & F.col("drawn_team").isNotNull(), "drawn", F.lit("offensive_fouls_drawn")),
        fact(defending, "person", F.lit("nonshooting_def_fouls")),
        fact(lost, "person", F.concat(F.lit("tov_"), F.when(lost, turnover_class("sub")))))
    return evs.select(F.explode(F.array_compact(facts)).alias("f")).groupBy(
        F.col("f.player_id").alias("player_id"), F.col("f.field").alias("field")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))


def turnover_types(evs: DataFrame) -> DataFrame:
    lost = evs.where(F.col("team").isNotNull() & (F.col("kind") == "tov") & F.col("person_played"))
    return lost.groupBy(F.col("sub").alias("type")).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "class", turnover_class("type"))


def foul_totals(evs: DataFrame) -> DataFrame:
    """Shooting fouls and the free-throw points they cost, overall (one row)."""
    live = F.col("team").isNotNull()
    shooting = (live & (F.col("kind") == "foul") & F.col("person_team").isNotNull()
                & F.col("sub").contains("shooting") & ~F.col("sub").contains("technical"))
    paid = live & (F.col("kind") == "fta") & F.col("made") & is_regular_free_throw("sub") & F.col("foul_pending")
    return evs.agg(F.count(F.when(shooting, 1)).cast("double").alias("shooting_fouls"),
                   F.count(F.when(paid, 1)).cast("double").alias("shooting_foul_ft_points"))


def assists(evs: DataFrame) -> DataFrame:
    """Helper of each made shot: by id, else by a name only one other team-mate carries."""
    named = F.array_except("assist_ids", F.array("person"))
    by_name = F.when(F.size(named) == 1, named[0])
    helper = F.coalesce(F.when(F.col("assist_team").isNotNull(), F.col("assist")), by_name)
    made = evs.where(F.col("team").isNotNull() & (F.col("kind") == "fga") & F.col("made"))
    return made.select("game_id", "event_id", helper.alias("assister"), F.when(
        F.col("person_team").isNotNull(), F.col("person")).alias("shooter")).where(F.col("assister").isNotNull())


def shots_with_minutes(evs: DataFrame, stretch: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Every shot with the shooter's minutes on the floor so far, where his entry time is exact."""
    shots = evs.where(F.col("team").isNotNull() & (F.col("kind") == "fga")).select(
        "game_id", "period", "ord", "t", "event_id",
        F.when(F.col("person_team").isNotNull(), F.col("person")).alias("shooter"),
        F.col("team").alias("team_id"), "value", "made", "distance", F.lit(1).alias("__rank"))
    entry = stretch.select(
        "game_id", "period", F.col("player_id").alias("shooter"), F.col("ord_in").alias("ord"), F.lit(0).alias("__rank"),
        F.struct(F.when(F.col("exact_in"), F.col("t_in")).alias("t"), "ord_out").alias("__entry"))
    both = shots.unionByName(entry, allowMissingColumns=True)
    keys = ["game_id", "period", "shooter"]
    seen = ordered_scan(both, keys, ["ord", "__rank"], {"__on": ("last", "__entry")}, cuts)
    on = F.col("__on.ord_out").isNull() | (F.col("ord") < F.col("__on.ord_out"))
    return seen.where(F.col("__rank") == 1).select(
        "game_id", "event_id", "shooter", "team_id", "value", "made", "distance",
        F.when(on & F.col("shooter").isNotNull(), (F.col("t") - F.col("__on.t")) / 600.0).alias("minutes_on"))


def usage(box_minutes: DataFrame) -> DataFrame:
    """Games, starts and minutes per (player, team). ``box_minutes``: person_id, team_id, position,
    minutes (double)."""
    starts = F.trim(F.coalesce("position", F.lit(""))) != ""
    return box_minutes.where(F.col("minutes") > 0).groupBy(
        F.col("person_id").alias("player_id"), "team_id").agg(
        F.count(F.lit(1)).alias("games_played"), F.count(F.when(starts, 1)).alias("games_started"),
        F.sum("minutes").alias("minutes"))
