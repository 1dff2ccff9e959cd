"""Lineups and counts on the floor: single teams in plain Python, whole games against a simulation that knows the truth."""

import random
from collections import Counter, defaultdict

import pytest

from tallywright.operators import events as ev
from tallywright.operators import lineups as lu
from tallywright.operators import ordered, recovery
from tallywright.operators.recovery import Moment, Row, TeamFloor
from tallywright.plans import game_log
from tallywright.plans.game_log import derive_game_tables
from tallywright.sources.payloads import ACTION_FIELDS

RED, TEAL = 7, 9
SQUAD = {RED: list(range(710, 719)), TEAL: list(range(910, 919))}
NAME = {p: f"{'Ro' if p < 900 else 'Te'}{'abcdefghi'[p % 10]}nak" for squad in SQUAD.values() for p in squad}
BOX = "game_id string, person_id bigint, team_id bigint, family_name string, first_name string, name_i string, position string, minutes string"


# ------------------------------------------------------------------ one team, row by row
def team(rows, five=None, members=range(1, 9), start=0):
    """rows: (position, clock, what) with what a player who acts, or (out, in) ids, or (out, [ids meant by a name])."""
    made = []
    for k, (at, t, what) in enumerate(rows):
        after = Moment(rows[k + 1][0], rows[k + 1][1], rows[k + 1][1]) if k + 1 < len(rows) else None
        if isinstance(what, tuple):
            out, coming = what
            named = isinstance(coming, list)
            made.append(Row(Moment(at, t, t), after, True, [out], [] if named else [coming], named, coming if named else [], None, out))
        else:
            made.append(Row(Moment(at, t, t), after, False, [], [], False, [], what, what))
    floor = TeamFloor(set(members))
    floor.play(2, start, made[0].at if made else Moment(0, start, start), made, five)
    return floor


def lineups(floor):
    return [(s[2], s[5]) for s in floor.segments]


def noted(floor):
    return [n[1] for n in floor.notes]


def test_starters_are_those_who_act_before_they_arrive():
    floor = team([(3, 10, 4), (5, 20, (2, 6)), (6, 30, 6), (8, 40, 1), (9, 50, 5), (11, 60, 3)])
    assert lineups(floor) == [(-1, [1, 2, 3, 4, 5]), (6, [1, 3, 4, 5, 6])] and noted(floor) == [recovery.INFERRED]


def test_two_leaving_at_once_leave_the_fifth_place_open():
    rows = [(1, 5, 1), (2, 6, 2), (3, 7, 3), (4, 8, 4)]
    floor = team(rows, None)
    both = Row(Moment(9, 90, 90), None, True, [5, 6], [7, 8], False, [], None, None)
    evidence = recovery.Evidence([both], {5, 6, 7, 8})
    assert lineups(floor)[0][1] is None and recovery.UNRESOLVED_START in noted(floor)
    assert evidence.lineup(0, set(), {1, 2, 3}) == ({1, 2, 3, 5, 6}, True)
    assert recovery.Evidence([both], set(range(1, 9))).lineup(0, {5}, {1, 2, 3}) == (None, False)


def test_the_last_period_fills_only_what_is_missing():
    floor = team([(1, 5, 1)], {1, 2, 3, 4, 5})
    floor.play(3, 100, Moment(20, 100, 100), [Row(Moment(20, 100, 100), None, False, [], [], False, [], 6, 6)], None)
    assert floor.segments[-1][5] is None  # six candidates for five places
    floor = team([(1, 5, 1)], {1, 2, 3, 4, 5})
    floor.play(3, 100, Moment(20, 100, 100), [Row(Moment(20, 100, 100), None, False, [], [], False, [], 3, 3)], None)
    assert floor.segments[-1][5] == [1, 2, 3, 4, 5] and noted(floor) == [recovery.INFERRED, recovery.COMPLETED]


def test_a_shared_name_goes_to_the_one_who_is_mentioned_first():
    floor = team([(1, 5, (1, [6, 7])), (2, 6, 2), (3, 7, 7), (4, 8, 6)], {1, 2, 3, 4, 5})
    assert lineups(floor)[1] == (2, [2, 3, 4, 5, 7]) and noted(floor) == [recovery.NEXT_SEEN]
    silent = team([(1, 5, (1, [6, 7])), (2, 6, 2)], {1, 2, 3, 4, 5})
    assert lineups(silent)[1] == (2, None) and noted(silent) == [recovery.UNRESOLVED_SUB]


def test_a_lost_lineup_stays_lost_until_evidence_is_full():
    rows = [(1, 5, (1, [])), (2, 6, 2), (3, 7, 3), (4, 8, (3, 8)), (6, 9, 8)]
    floor = team(rows, {1, 2, 3, 4, 5})
    assert lineups(floor) == [(-1, [1, 2, 3, 4, 5]), (2, None), (5, None)] and noted(floor) == [recovery.UNRESOLVED_SUB]
    # the newcomer acts: with the four who stayed the lineup is whole again at once
    floor = team([(1, 5, (1, [])), (2, 6, 2), (7, 9, 6)], {1, 2, 3, 4, 5})
    assert lineups(floor) == [(-1, [1, 2, 3, 4, 5]), (2, None), (2, [2, 3, 4, 5, 6])]
    assert noted(floor) == [recovery.UNRESOLVED_SUB, recovery.RECOVERED] and [s[6] for s in floor.segments] == [True, False, False]


def test_a_lineup_found_later_starts_at_an_event():
    rows = [(1, 5, (6, 7)), (2, 6, 1), (3, 7, (8, 1)), (4, 8, 2), (5, 9, 3), (6, 10, 4), (7, 11, 5), (8, 12, 1)]
    floor = team(rows, None)
    assert lineups(floor)[-1][1] is not None and recovery.RECOVERED in noted(floor)


@pytest.mark.parametrize(("five", "swap", "word"), [
    ({1, 2, 3, 4, 5}, (6, 7), "not on"), ({1, 2, 3, 4, 5}, (1, 2), "4 players"), ({1, 2, 3, 4, 5}, (1, [2]), "on already")])
def test_reasons_of_lost_lineups(five, swap, word):
    floor = team([(1, 5, swap)], five)
    assert word in floor.notes[0][2] and floor.notes[0][1] == recovery.UNRESOLVED_SUB


# ------------------------------------------------------------------ whole games
def clock(period, t):
    left = period * 7200 - t
    return f"PT{left // 600:02d}M{left % 600 // 10:02d}.{left % 10}0S"


def simulate(game, seed, dialect, periods=3, moments=40, loud_breaks=True):
    """(actions, truth): a random game in one dialect and what every player saw of it."""
    rng = random.Random(seed)
    on = {t: set(SQUAD[t][:5]) for t in SQUAD}
    seen, seconds, acted, points = defaultdict(Counter), Counter(), Counter(), Counter()
    actions, number = [], 0

    def say(period, t, team_id, person, kind, sub="", text="", **more):
        nonlocal number
        number += 1
        actions.append(dict(game_id=game, actionNumber=number, clock=clock(period, t), period=period, teamId=team_id, personId=person, actionType=kind,
                            subType=sub, descriptor="", description=text, isFieldGoal=int("Shot" in kind), **more))

    def count(side, own, faced):
        for t in SQUAD:
            for p in on[t]:
                for f in (own if t == side else faced):
                    seen[p][f] += 1

    text = dialect == "text"
    for period in range(1, periods + 1):
        start = (period - 1) * 7200
        say(period, start, 0, 0, "period", "start")
        if period > 1 and not loud_breaks:  # a swap at the break that the log does not tell
            for t in SQUAD:
                on[t].remove(rng.choice(sorted(on[t])))
                on[t].add(rng.choice(sorted(set(SQUAD[t]) - on[t])))
        at, last, missed = start, start, None
        told = [(t, p) for t in SQUAD for p in sorted(on[t])]
        rng.shuffle(told)
        steps = [("view", t, p) for t, p in told] if period > 1 else []  # everyone acts before anything changes
        for k in range(moments + len(steps)):
            at += rng.randint(1, 7200 // (moments + 12))
            for t in SQUAD:
                for p in on[t]:
                    seconds[p] += at - last
            last = at
            what, side, who = steps[k] if k < len(steps) else (rng.choice(["make", "miss", "grab", "view", "swap"]), rng.choice((RED, TEAL)), None)
            who = who or rng.choice(sorted(on[side]))
            if what == "swap":
                new = rng.choice(sorted(set(SQUAD[side]) - on[side]))
                if text:
                    say(period, at, side, who, "Substitution", "", f"SUB: {NAME[new]} FOR {NAME[who]}")
                else:
                    say(period, at, side, who, "substitution", "out")
                    say(period, at, side, new, "substitution", "in")
                on[side] = on[side] - {who} | {new}
            elif what in ("make", "miss"):
                made = what == "make"
                count(side, ["team_fga", "team_fgm" if made else "team_missed_fga"], ["opp_fga", "opp_fg2a"] + ["opp_missed_fga"] * (not made))
                points[side] += 2 * made
                missed = None if made else side
                if text:
                    say(period, at, side, who, "Made Shot" if made else "Missed Shot", "Hook", f"{'' if made else 'MISS '}{NAME[who]} Hook")
                else:
                    say(period, at, side, who, "2pt", "Hook", shotResult="Made" if made else "Missed", shotDistance=9.0)
            elif what == "grab":
                if missed is not None:
                    count(side, ["team_oreb" if missed == side else "team_dreb"], ["opp_oreb" if missed == side else "opp_dreb"])
                missed = None
                say(period, at, side, who, "Rebound" if text else "rebound", "", NAME[who])
            else:
                count(side, ["team_tov"], ["opp_tov"])
                acted[who] += 1
                missed = None
                say(period, at, side, who, "Turnover" if text else "turnover", "Bad Pass" if text else "bad pass", NAME[who])
        for t in SQUAD:
            for p in on[t]:
                seconds[p] += period * 7200 - last
        say(period, period * 7200, 0, 0, "period", "end")
    return actions, {"seen": seen, "seconds": seconds, "acted": acted, "points": points}


def log_frame(spark, games):
    rows = [(a["game_id"], i, *[a.get(n) for n in ACTION_FIELDS]) for actions in games for i, a in enumerate(actions)]
    return spark.createDataFrame(rows, "game_id string, ord int, " + ", ".join(f"`{n}` {kind}" for n, kind in ACTION_FIELDS.items()))


def box_frame(spark, games):
    return spark.createDataFrame([(g, p, t, NAME[p], None, None, "G" if p % 10 < 5 else "", "11:00") for g in games for t in SQUAD for p in SQUAD[t]], BOX)


def per_game(tables):
    cols = [*lu.TEAM_FIELDS, *lu.OPP_FIELDS]
    rows = lu.on_floor_counts(lu.span_totals(lu.event_fields(tables.events)), tables.spans, ("game_id",)).collect()
    return {(r.game_id, r.player_id): {c: int(r[c]) for c in cols if r[c]} for r in rows}


@pytest.fixture(scope="module")
def simulated(spark):
    made = {f"{d}{i}{'' if loud else 'q'}": simulate(f"{d}{i}{'' if loud else 'q'}", 31 * i + len(d), d, loud_breaks=loud)
            for d in ("text", "id") for i in (1, 2) for loud in (True, False)}
    text = log_frame(spark, [a for g, (a, _) in made.items() if g.startswith("text")])
    ids = log_frame(spark, [a for g, (a, _) in made.items() if g.startswith("id")])
    return derive_game_tables(box_frame(spark, made), id_log=ids, text_log=text), {g: truth for g, (_, truth) in made.items()}


def test_counts_equal_the_simulated_truth(simulated):
    tables, truth = simulated
    got = per_game(tables)
    for g, t in truth.items():
        for p in (p for squad in SQUAD.values() for p in squad):
            assert got.get((g, p), {}) == dict(t["seen"][p]), (g, p)
    assert all(r.events_unresolved == 0 for r in tables.event_totals.collect())


def test_seconds_and_points_equal_the_simulated_truth(simulated):
    tables, truth = simulated
    got = {(r.game_id, r.player_id): r.seconds for r in tables.seconds.collect()}
    scored = Counter()
    for r in tables.stints.collect():
        scored[r.game_id, r.offense_team] += r.pts
    for g, t in truth.items():
        assert {p: got[g, p] for p in t["seconds"] if (g, p) in got} == pytest.approx({p: s / 10 for p, s in t["seconds"].items() if s})
        assert {side: scored[g, side] for side in SQUAD} == {side: t["points"][side] for side in SQUAD}


def test_player_events_equal_the_simulated_truth(simulated):
    tables, truth = simulated
    want = Counter()
    for t in truth.values():
        want.update(t["acted"])
    assert {r.player_id: r.value for r in tables.player_events.collect() if r.field == "tov_bad_pass"} == dict(want)


def test_hot_games_give_the_same_tables(spark, simulated, monkeypatch):
    """With every game treated as hot, the ordered passes must agree with the plain ones."""
    actions, _ = simulate("hot", 77, "text", periods=2, moments=20)
    log, box = log_frame(spark, [actions]), box_frame(spark, ["hot"])
    plain = derive_game_tables(box, text_log=log)
    monkeypatch.setattr(game_log, "plan_cuts", lambda df, keys, order: ordered.plan_cuts(df, keys, order, 9))
    cut_up = derive_game_tables(box, text_log=log)
    for name in ("segments", "events", "on_floor", "stints"):
        a, b = getattr(plain, name), getattr(cut_up, name)
        assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count(), name


def test_rotation_comes_before_the_log(spark):
    actions, _ = simulate("rot", 5, "id", periods=2, moments=12)
    spells = [("rot", p, t, 7200.0, 14400.0) for t in SQUAD for p in SQUAD[t][4:9]]
    rotation = spark.createDataFrame(spells, "game_id string, PERSON_ID bigint, TEAM_ID bigint, IN_TIME_REAL double, OUT_TIME_REAL double")
    tables = derive_game_tables(box_frame(spark, ["rot"]), id_log=log_frame(spark, [actions]), rotation=rotation)
    first = {(r.period, r.team): r.players for r in tables.segments.where("seg_no = 0").collect()}
    assert first == {(1, t): SQUAD[t][:5] for t in SQUAD} | {(2, t): SQUAD[t][4:9] for t in SQUAD}


def test_blocks_and_fouls_of_the_id_log(spark):
    a, b = SQUAD[RED], SQUAD[TEAL]

    def row(n, second, side, person, kind, sub="", descriptor="", **more):
        return dict(game_id="f", actionNumber=n, clock=clock(1, second * 10), period=1, teamId=side, personId=person, actionType=kind, subType=sub, descriptor=descriptor, **more)

    log = [row(1, 0, None, 0, "period", "start"),
           row(2, 30, TEAL, b[0], "3pt", "", "", shotResult="Missed", shotDistance=24.0, blockPersonId=a[3], possession=TEAL),
           row(3, 33, TEAL, b[4], "rebound", "", possession=TEAL),
           row(4, 41, RED, a[1], "foul", "personal", "shooting", foulDrawnPersonId=b[4], possession=TEAL),
           row(5, 41, TEAL, b[4], "freethrow", "1 of 2", shotResult="Missed"), row(6, 41, TEAL, b[4], "freethrow", "2 of 2", shotResult="Made"),
           row(7, 77, RED, a[0], "2pt", "", "", shotResult="Made", shotDistance=3.0, assistPersonId=a[2], possession=RED),
           row(8, 95, TEAL, b[2], "2pt", "", "", shotResult="Missed", shotDistance=2.0, blockPersonId=a[4], possession=TEAL),
           row(9, 97, RED, a[4], "rebound", "", possession=RED),
           row(10, 120, RED, a[0], "foul", "offensive", "", foulDrawnPersonId=b[1], possession=RED),
           row(11, 150, TEAL, b[3], "foul", "personal", "", foulDrawnPersonId=a[2], possession=RED),
           row(12, 720, None, 0, "period", "end")]
    t = derive_game_tables(box_frame(spark, ["f"]), id_log=log_frame(spark, [log]))
    got = {(r.player_id, r.field) for r in t.player_events.collect()}
    assert got == {(a[3], "pbp_blocks"), (a[3], "pbp_blocks_P3"), (a[4], "pbp_blocks"), (a[4], "pbp_blocks_R"), (a[4], "pbp_blocks_recovered"),
                   (a[1], "shooting_fouls"), (b[1], "offensive_fouls_drawn"), (b[3], "nonshooting_def_fouls")}
    assert tuple(t.fouls.first()) == (1.0, 1.0) and [tuple(r) for r in t.assists.collect()] == [("f", 7, a[2], a[0])]
    assert {r.event_id: round(r.minutes_on, 3) for r in t.shots.collect()} == {2: 0.5, 7: round(77 / 60, 3), 8: round(95 / 60, 3)}


def test_blockers_of_the_text_log(spark):
    a, b = SQUAD[RED], SQUAD[TEAL]

    def row(n, side, person, kind, text):
        return dict(game_id="k", actionNumber=n, clock=clock(1, 60 * n), period=1, teamId=side, personId=person, actionType=kind, subType="", description=text,
                    isFieldGoal=int("Shot" in kind))

    log = [row(1, TEAL, b[1], "Missed Shot", f"MISS {NAME[b[1]]} Tip"), row(2, RED, a[2], "", f"{NAME[a[2]]} BLOCK"), row(2, RED, a[1], "", f"{NAME[a[1]]} BLOCK"),
           row(3, RED, a[0], "Made Shot", f"{NAME[a[0]]} Dunk ({NAME[a[4]]} 2 AST)"), row(4, TEAL, b[0], "", f"{NAME[b[0]]} BLOCK")]
    got = {r.event_id: r for r in ev.normalize_text_log(log_frame(spark, [log]), ev.game_rosters(box_frame(spark, ["k"]))).where("kind = 'fga'").collect()}
    assert got[1].blocker == a[2] and got[3].blocker is None and got[3].assist_name == NAME[a[4]]


# ------------------------------------------------------------------ lost lineups and the plan of the walk
class Asking(TeamFloor):
    """Asks for a lost lineup before every event."""

    def on_event(self, at, i):
        self.lost_until = -1
        super().on_event(at, i)


def lost_walk(kind, rows, five, monkeypatch):
    asked = []
    real = recovery.Evidence.lineup
    monkeypatch.setattr(recovery.Evidence, "lineup", lambda self, i, *a: asked.append(i) or real(self, i, *a))
    floor = kind(set(range(1, 12)))
    for period in (1, 2):
        floor.play(period, 0, rows[0].at, rows, five)
    monkeypatch.undo()
    return floor.segments, floor.notes, len(asked)


@pytest.mark.parametrize("seed", range(60))
def test_a_lost_lineup_is_the_same_asked_for_less_often(seed, monkeypatch):
    rng = random.Random(seed)
    rows = []
    for k in range(120):
        at, after = Moment(k, k, k), Moment(k + 1, k + 1, k + 1)
        p = rng.randint(1, 11 if seed % 2 else 7)
        if rng.random() < (0.02, 0.1, 0.3)[seed % 3]:
            coming = [rng.randint(1, 11)] if rng.random() < 0.6 else []
            rows.append(Row(at, after, True, [p], coming, rng.random() < 0.2, [rng.randint(1, 11)] if rng.random() < 0.5 else [], None, p))
        else:
            rows.append(Row(at, after, False, [], [], False, [], p if rng.random() < 0.9 else None, p))
    five = {1, 2, 3, 4, 5} if seed % 4 else None
    less, every = lost_walk(TeamFloor, rows, five, monkeypatch), lost_walk(Asking, rows, five, monkeypatch)
    assert less[:2] == every[:2] and less[2] <= every[2]


def test_a_long_lost_lineup_is_asked_for_a_few_times(monkeypatch):
    rows = [Row(Moment(k, k, k), Moment(k + 1, k + 1, k + 1), False, [], [], False, [], 1 + k % 3, 1 + k % 3) for k in range(2000)]
    assert lost_walk(TeamFloor, rows, None, monkeypatch)[2] <= 20


def test_team_games_are_read_in_batches_not_group_by_group(spark):
    box = spark.createDataFrame([(f"g{g}", p, t, NAME[p], "", "", "G" if k < 5 else "", "10:00") for g in range(9) for t in (RED, TEAL) for k, p in enumerate(SQUAD[t])], BOX)
    rosters = ev.game_rosters(box)
    kinds = ("game_id string, period int, ord bigint, t int, kind string, team bigint, person bigint, sub string, outs array<bigint>, ins array<bigint>, in_name string, "
             "in_ids array<bigint>")
    evs = spark.createDataFrame([(f"g{g}", 1, i, i * 10, "sub" if i == 3 else "reb", RED, 710 + i % 3, "", [711] if i == 3 else [], [717] if i == 3 else [], None, None)
                                 for g in range(9) for i in range(6)], kinds)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # team games reach over batches
    try:
        walked = lu.lineup_segments(evs, rosters)
        assert "CoGroup" not in walked._jdf.queryExecution().toString()
        made = {(r.game_id, r.team, r.seg_no): (r.ord_from, r.players) for r in lu.segments_only(walked).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(f"g{g}", RED, 0): (-1, SQUAD[RED][:5]) for g in range(9)} | {(f"g{g}", TEAL, 0): (-1, SQUAD[TEAL][:5]) for g in range(9)}
    want |= {(f"g{g}", RED, 1): (4, [710, 712, 713, 714, 717]) for g in range(9)}
    assert made == want
