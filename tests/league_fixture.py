"""A small made-up season as Spark tables: consistent logs, box scores and season dashboards."""

import datetime as dt

import numpy as np

from tallywright.plans.assemble import BOX_COUNTS, PLAY_TYPES, REQUIRED
from tallywright.plans.specs import COMBINE_TESTS
from tallywright.sources.payloads import ACTION_FIELDS

TEAMS, PER_TEAM, ROUNDS, POSSESSIONS = 30, 8, 3, 70
LABELS = ("G", "G-F", "F", "F-C", "C", "F-G", "C-F", "F")
ACTIONS = (("Driving Layup Shot", "Restricted Area", 2, 0, 5), ("Driving Dunk Shot", "Restricted Area", 2, 0, 3),
           ("Dunk Shot", "Restricted Area", 2, 0, 3), ("Hook Shot", "In The Paint (Non-RA)", 2, 4, 12),
           ("Pullup Jump Shot", "Mid-Range", 2, 12, 22), ("Jump Shot", "Above the Break 3", 3, 23, 28))
AREAS = ("Center(C)", "Left Side(L)", "Right Side(R)")


class Season:
    def __init__(self, seed=7):
        self.rng = np.random.default_rng(seed)
        self.inactive = []
        self.roster = [(1000 * t + k, t) for t in range(1, TEAMS + 1) for k in range(PER_TEAM)]
        self.skill = {p: self.rng.normal() for p, _t in self.roster}
        self.last = {p: {c: 0.0 for c in (*BOX_COUNTS, "FG3M", "FG3A", "MIN", "GP")} for p, _t in self.roster}
        self.actions, self.box, self.chart, self.logs, self.team_rows, self.homes = [], [], [], [], [], []
        for i, (p, t) in enumerate(self.roster):     # an earlier season's inactive lists
            self.inactive += [(f"001{j:05d}", p, t) for j in range(int(self.rng.integers(4)) if i % 3 else 0)]
        number = 0
        for r in range(ROUNDS):
            order = self.rng.permutation(np.arange(1, TEAMS + 1))
            for g in range(TEAMS // 2):
                number += 1
                self.game(f"002{number:05d}", int(order[2 * g]), int(order[2 * g + 1]), dt.date(2025, 10, 20) + dt.timedelta(days=r))

    def clock(self, t):
        left = 7200 - t % 7200 if t % 7200 else 7200
        return f"PT{left // 600:02d}M{left % 600 / 10:05.2f}S"

    def game(self, gid, home, away, day):
        rng = self.rng
        who = {t: [p for p, team in self.roster if team == t] for t in (home, away)}
        floor = {t: who[t][:5] for t in who}
        line = {p: {c: 0.0 for c in (*BOX_COUNTS, "FG3M", "FG3A")} for t in who for p in who[t]}
        on, number, points = dict.fromkeys(line, 0), 1, {home: 0, away: 0}

        def act(t, team, person, kind, sub="", desc="", **more):
            nonlocal number
            number += 1
            self.actions.append(dict(game_id=gid, actionNumber=number, clock=self.clock(t), period=min(4, t // 7200 + 1), teamId=team,
                                     personId=person, actionType=kind, subType=sub, descriptor=desc, **more))
            return number

        act(0, None, 0, "period", "start")
        attack, spread, since = home, 28800 // POSSESSIONS, 0

        def settle(t):
            nonlocal since
            for team in floor:
                for q in floor[team]:
                    on[q] += t - since
            since = t

        for n in range(POSSESSIONS):
            t = n * spread + 40
            defend = away if attack == home else home
            if n and n % 6 == 0:
                settle(t)
                for team in (attack, defend):
                    out = floor[team][int(rng.integers(5))]
                    come = [p for p in who[team][:-1] if p not in floor[team]][int(rng.integers(2))]
                    act(t, team, out, "substitution", "out")
                    act(t, team, come, "substitution", "in")
                    floor[team] = [come if p == out else p for p in floor[team]]
            p, d = floor[attack][int(rng.integers(5))], floor[defend][int(rng.integers(5))]
            if rng.random() < 0.14:
                lost = ("bad pass", "lost ball", "offensive foul")[int(rng.integers(3))]
                if lost == "offensive foul":
                    act(t, attack, p, "foul", "offensive", "charge", foulDrawnPersonId=d, possession=attack)
                    line[p]["PF"] += 1
                act(t, attack, p, "turnover", lost, possession=attack)
                line[p]["TOV"] += 1
                line[d]["STL"] += lost != "offensive foul"
            else:
                if rng.random() < 0.1:
                    act(t, defend, d, "foul", "personal", "", possession=attack)
                    line[d]["PF"] += 1
                if rng.random() < 0.14:
                    act(t, defend, d, "foul", "personal", "shooting", foulDrawnPersonId=p, possession=attack)
                    line[d]["PF"] += 1
                    for i in (1, 2):
                        good = rng.random() < 0.75 + 0.06 * self.skill[p]
                        act(t, attack, p, "freethrow", f"{i} of 2", shotResult="Made" if good else "Missed", possession=attack)
                        line[p]["FTA"] += 1
                        line[p]["FTM"] += good
                        line[p]["PTS"] += good
                        points[attack] += int(good)
                    if not good:
                        act(t + 5, defend, d, "rebound", "defensive", possession=defend)
                        line[d]["DREB"] += 1
                else:
                    name, zone, value, near, far = ACTIONS[int(rng.integers(len(ACTIONS)))]
                    dist = int(rng.integers(near, far + 1))
                    good = rng.random() < 1 / (1 + np.exp(-(0.3 - 0.05 * dist + 0.4 * self.skill[p])))
                    mate = [m for m in floor[attack] if m != p][int(rng.integers(4))]
                    blocked = not good and rng.random() < 0.15
                    e = act(t, attack, p, f"{value}pt", name.lower(), "", shotResult="Made" if good else "Missed", shotDistance=float(dist),
                            assistPersonId=mate if good and rng.random() < 0.6 else None, blockPersonId=d if blocked else None, possession=attack)
                    self.chart.append((gid, e, p, attack, t // 7200 + 1, (7200 - t % 7200) // 600, (7200 - t % 7200) % 600 // 10, name,
                                       f"{value}PT Field Goal", zone, AREAS[int(rng.integers(3))], float(dist), float(rng.integers(-200, 200)), 5.0, 1,
                                       int(good), day.isoformat()))
                    line[p]["FGA"] += 1
                    line[p]["FG3A"] += value == 3
                    line[d]["BLK"] += blocked
                    if good:
                        line[p]["FGM"] += 1
                        line[p]["FG3M"] += value == 3
                        line[p]["PTS"] += value
                        points[attack] += value
                        if self.actions[-1]["assistPersonId"]:
                            line[mate]["AST"] += 1
                    else:
                        own = rng.random() < 0.25
                        team, grab = (attack, mate) if own else (defend, floor[defend][int(rng.integers(5))])
                        act(t + 5, team, grab, "rebound", "offensive" if own else "defensive", possession=team)
                        line[grab]["OREB" if own else "DREB"] += 1
            attack = defend
        settle(28800)
        act(28800, None, 0, "period", "end")
        self.actions[-1]["clock"], self.actions[-1]["period"] = "PT00M00.00S", 4
        for t in who:
            for p in who[t]:
                mins = on[p] / 600
                idle = on[p] == 0
                self.box.append((gid, p, t, f"F{p}", f"L{p}", f"F. L{p}", "G" if p in who[t][:5] else "", "DNP - Injury" if idle else "",
                                 "" if idle else f"{round(mins * 60) // 60}:{round(mins * 60) % 60:02d}"))
                for c, v in line[p].items():
                    self.last[p][c] += v
                self.last[p]["MIN"] += mins
                self.last[p]["GP"] += not idle
                if not idle:
                    self.logs.append((p, gid, day.isoformat(), f"{mins:.3f}", *[float(line[p][c]) for c in BOX_COUNTS]))
            self.team_rows.append((t, gid, day.isoformat(), "vs.", float(points[t])))
        self.homes.append((gid, home, away))
        self.inactive.append((gid, 1000 * home + PER_TEAM - 1, home))


def raw_tables(spark, season=None):
    s = season or Season()
    rng = np.random.default_rng(3)
    ids = [p for p, _t in s.roster]
    seen = {p: v for p, v in s.last.items() if v["GP"] > 0}

    def make(rows, schema):
        kinds = [c.split()[1] for c in schema.split(", ")]

        def plain(v, kind):
            v = v.item() if isinstance(v, np.generic) else v
            return float(v) if kind == "double" and v is not None else v

        return spark.createDataFrame([tuple(plain(v, k) for v, k in zip(row, kinds)) for row in rows], schema)

    def counts(columns, top):
        """Small independent counts per player who played; ``top`` bounds each."""
        return [(p, *[float(rng.binomial(top, min(0.9, max(0.1, 0.4 + 0.1 * s.skill[p])))) for _ in columns]) for p in seen]

    def doubles(names):
        return ", ".join(f"{c} double" for c in names.split()) if isinstance(names, str) else ", ".join(f"{c} double" for c in names)

    names = list(ACTION_FIELDS)
    order, log = {}, []
    for a in s.actions:
        i = order[a["game_id"]] = order.get(a["game_id"], -1) + 1
        log.append((a["game_id"], i, *[a.get(n) for n in names]))
    base = REQUIRED["player_base_totals"][2:]
    hustle = REQUIRED["player_hustle"][1:]
    passing = REQUIRED["pt_Passing"][1:]
    drives = REQUIRED["pt_Drives"][1:]
    reb = REQUIRED["pt_Rebounding"][1:]
    out = {
        "id_log": make(log, "game_id string, ord int, " + ", ".join(f"`{n}` {ACTION_FIELDS[n]}" for n in names)),
        "box": make(s.box, "game_id string, person_id bigint, team_id bigint, first_name string, family_name string, name_i string, "
                           "position string, comment string, minutes string"),
        "shot_chart": make(s.chart, "GAME_ID string, GAME_EVENT_ID bigint, PLAYER_ID bigint, TEAM_ID bigint, PERIOD int, MINUTES_REMAINING int, "
                           "SECONDS_REMAINING int, ACTION_TYPE string, SHOT_TYPE string, SHOT_ZONE_BASIC string, SHOT_ZONE_AREA string, "
                           "SHOT_DISTANCE double, LOC_X double, LOC_Y double, SHOT_ATTEMPTED_FLAG int, SHOT_MADE_FLAG int, GAME_DATE string"),
        "player_game_logs": make(s.logs, "PLAYER_ID bigint, GAME_ID string, GAME_DATE string, MIN string, " + doubles(BOX_COUNTS)),
        "team_game_log": make(s.team_rows, "TEAM_ID bigint, GAME_ID string, GAME_DATE string, MATCHUP string, PTS double"),
        "homes": make(s.homes, "game_id string, home bigint, away bigint"),
        "player_base_totals": make([(p, p // 1000, *[float(v[c]) for c in base]) for p, v in seen.items()],
                                   "PLAYER_ID bigint, TEAM_ID bigint, " + doubles(base)),
        "player_clutch_base": make([(p, 1.0, float(min(1, v["FGA"])), 0.0) for p, v in seen.items() if v["FGA"] >= 3],
                                   "PLAYER_ID bigint, PTS double, FGA double, FTA double"),
        "player_hustle": make([(p, *[float(rng.binomial(4, 0.3 + 0.15 * (s.skill[p] > 0))) for _ in hustle]) for p in seen],
                              "PLAYER_ID bigint, " + doubles(hustle)),
        "pt_Drives": make(counts(drives, 9), "PLAYER_ID bigint, " + doubles(drives)),
        "pt_Passing": make([(p, float(40 + rng.integers(40)), *[float(rng.binomial(12, 0.4)) for _ in passing[1:]]) for p in seen],
                           "PLAYER_ID bigint, " + doubles(passing)),
        "pt_Possessions": make([(p, float(60 + rng.integers(60)), 1.0 + rng.random() * 3) for p in seen],
                               "PLAYER_ID bigint, TOUCHES double, AVG_DRIB_PER_TOUCH double"),
        "pt_Rebounding": make([(p, v["OREB"], v["DREB"], v["OREB"] + 1 + rng.integers(2), v["DREB"] + 1 + rng.integers(3), float(rng.integers(2)),
                                float(rng.integers(2))) for p, v in ((p, {k: float(x) for k, x in v.items()}) for p, v in seen.items())],
                              "PLAYER_ID bigint, " + doubles(reb)),
        "pt_SpeedDistance": make([(p, float(v["MIN"]), 4 + rng.random(), 4 + rng.random(), v["MIN"] * (0.04 + rng.random() / 100), v["MIN"] * 0.04)
                                  for p, v in seen.items()], "PLAYER_ID bigint, " + doubles(REQUIRED["pt_SpeedDistance"][1:])),
        "pt_shot": make([(p, g, d, 4.0 + rng.integers(5), float(rng.integers(3)), 3.0 + rng.integers(3)) for p in seen
                         for g in ("Catch and Shoot", "Pullups") for d in ("", "0-2", "2-4", "4-6", "6+")],
                        "PLAYER_ID bigint, general_range string, def_dist string, FGA double, FG3M double, FG3A double"),
        "pt_shot_clock": make([(p, c, float(min(1, v["FGA"] // 4))) for p, v in seen.items() for c in ("7-4 Late", "4-0 Very Late", "24-22")],
                              "PLAYER_ID bigint, clock_range string, FGA double"),
        "synergy": make([(p, "offensive", k, 2.0 + rng.integers(6), float(rng.integers(9))) for p in seen for k in PLAY_TYPES]
                        + [(p, "defensive", "Postup", 2.0 + rng.integers(6), float(rng.integers(9))) for p in seen],
                        "PLAYER_ID bigint, side string, play_type string, POSS double, PTS double"),
        "combine_anthro": make([(p, 2018 + k, 78.0 + s.skill[p] + k) for p in ids[::3] for k in (0, 1)], "PLAYER_ID bigint, year int, WINGSPAN double"),
        "combine_drills": make([(p, 2019, *[None if (p + i) % 7 == 0 else 3.0 + i + rng.random() for i in range(6)]) for p in ids[::4]],
                               "PLAYER_ID bigint, year int, " + doubles(COMBINE_TESTS)),
        "roster": make([(t, p, f"F{p} L{p}", str(i % 99), LABELS[i % PER_TEAM], f"6-{i % 11}", "" if i % 50 == 0 else str(190 + i % 60), "1999-01-01",
                         20.0 + i % 15, "3", i) for i, (p, t) in enumerate(s.roster)],
                       "TeamID bigint, PLAYER_ID bigint, PLAYER string, NUM string, POSITION string, HEIGHT string, WEIGHT string, BIRTH_DATE string, "
                       "AGE double, EXP string, roster_order int"),
        "player_index": make([(p, "6-5", "210") for p in ids], "PERSON_ID bigint, HEIGHT string, WEIGHT string"),
        "team_base_totals": make([(t, f"T{t}", 3.0, 300.0 + t, t) for t in range(1, TEAMS + 1)],
                                 "TEAM_ID bigint, TEAM_NAME string, GP double, PTS double, PTS_RANK int"),
        "team_advanced_totals": make([(t, 95.0 + t % 7, 110.0) for t in range(1, TEAMS + 1)], "TEAM_ID bigint, PACE double, OFF_RATING double"),
        "teams": make([(t, f"T{t:02d}", f"City {t}", f"Name {t}") for t in range(1, TEAMS + 1)],
                      "team_id bigint, abbreviation string, city string, name string"),
    }
    rows = {"Overall": [], "P3": [], "P2ALL": [], "R": []}
    for p in seen:
        p3, rim, mid = 3 + int(rng.integers(5)), 2 + int(rng.integers(5)), 2 + int(rng.integers(3))
        for cat, a in (("P3", p3), ("P2ALL", rim + mid), ("R", rim), ("Overall", p3 + rim + mid)):
            m = int(rng.binomial(a, 0.45 - 0.05 * s.skill[p] if abs(s.skill[p]) < 3 else 0.4))
            rows[cat].append((p, float(m), float(a), 0.45))
    cols = {"Overall": ("D_FGM", "D_FGA", "NORMAL_FG_PCT"), "P3": ("FG3M", "FG3A", "NS_FG3_PCT"), "P2ALL": ("FG2M", "FG2A", "NS_FG2_PCT"),
            "R": ("D_FGM", "D_FGA", "NORMAL_FG_PCT")}
    out["contests"] = {c: make(rows[c], "CLOSE_DEF_PERSON_ID bigint, " + doubles(cols[c])) for c in rows}
    out["seasons"] = (out["box"], make(s.inactive, "game_id string, person_id bigint, team_id bigint"))
    return out
