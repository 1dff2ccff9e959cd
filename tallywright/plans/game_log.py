"""From raw logs and box scores to every table the log gives: one pass plan for both dialects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators import events as ev
from tallywright.operators import lineups as lu
from tallywright.operators.ordered import plan_cuts
from tallywright.plans.lineage import cut


@dataclass
class GameTables:
    """Tables of the walk; all are DataFrames keyed by game, player or both."""

    named: DataFrame
    rosters: DataFrame
    rotation: DataFrame | None
    events: DataFrame
    segments: DataFrame
    spans: DataFrame
    notes: DataFrame
    on_floor: DataFrame
    player_events: DataFrame
    turnover_types: DataFrame
    fouls: DataFrame
    seconds: DataFrame
    stretches: DataFrame
    stretch_minutes: DataFrame
    shots: DataFrame
    assists: DataFrame
    stints: DataFrame
    event_totals: DataFrame


def derive_game_tables(box: DataFrame, id_log: DataFrame | None = None, text_log: DataFrame | None = None,
                       rotation: DataFrame | None = None) -> GameTables:
    """``id_log`` is preferred; games only ``text_log`` has use it as the backup."""
    rosters = ev.game_rosters(box).persist()
    parts, spoken = [], []
    if text_log is not None:
        rest = text_log
        if id_log is not None:
            rest = text_log.join(id_log.select("game_id").distinct(), "game_id", "left_anti")
        parts.append(ev.normalize_text_log(rest, rosters, plan_cuts(rest, ["game_id"], "ord")))
        spoken.append(rest)
    if id_log is not None:
        parts.append(ev.normalize_id_log(id_log, rosters, plan_cuts(id_log, ["game_id"], "ord")))
        spoken.append(id_log)
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    said = [s.select("game_id", "personId", *[c for c in ("playerName", "playerNameI") if c in s.columns])
            for s in spoken]
    said_all = said[0] if len(said) == 1 else said[0].unionByName(said[1], allowMissingColumns=True)
    evs = cut(ev.with_name_candidates(log, ev.name_index(box, said_all, rosters)))
    spells = ev.rotation_intervals(rotation) if rotation is not None else None
    cuts = plan_cuts(evs, ["game_id", "period"], "ord")
    walked = cut(lu.lineup_segments(evs, rosters, spells, cuts))
    segments = lu.segments_only(walked)
    spans = cut(lu.ten_man_spans(segments, rosters))
    placed = lu.attach_spans(evs, spans, cuts)
    stated = cut(lu.with_state(placed, rosters, cuts))
    fields = lu.event_fields(stated)
    totals = cut(lu.span_totals(fields))
    stretch = cut(lu.stretches(segments))
    return GameTables(
        named=evs, rosters=rosters, rotation=spells, events=stated, segments=segments, spans=spans, notes=lu.notes_only(walked),
        on_floor=lu.on_floor_counts(totals, spans), player_events=lu.player_event_counts(stated),
        turnover_types=lu.turnover_types(stated), fouls=lu.foul_totals(stated), seconds=lu.seconds_on(segments),
        stretches=stretch, stretch_minutes=lu.stretch_minutes(stretch),
        shots=lu.shots_with_minutes(stated, stretch, cuts), assists=lu.assists(stated),
        stints=lu.stint_rows(totals, spans), event_totals=lu.event_totals(fields))


def totals_row(tables: GameTables) -> DataFrame:
    return tables.event_totals.agg(F.coalesce(F.sum("events_total"), F.lit(0)).alias("events_total"),
                                   F.coalesce(F.sum("events_unresolved"), F.lit(0)).alias("events_unresolved"))
