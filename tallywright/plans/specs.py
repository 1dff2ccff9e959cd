"""What is derived, as data: shrunk statistics, tendencies, score components.

Expressions are SQL over the wide input columns. All names, columns and weights are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass

OFF100 = "OFF_POSS / 100.0"
DEF100 = "DEF_POSS / 100.0"

ATTRIBUTE_GROUPS = {
    "Rim scoring": ("driving_layup", "driving_dunk", "standing_dunk", "touch", "post_scoring"),
    "Shooting": ("three_pointer", "mid_range", "free_throw"),
    "Playmaking": ("ball_handle", "passing_accuracy", "vision", "offensive_iq"),
    "Defense": ("offensive_rebounding", "defensive_rebounding", "steals", "shot_blocking", "off_ball_defense",
                "on_ball_defense", "post_defense", "rim_protection", "defensive_iq"),
    "Physicals": ("speed", "acceleration", "lateral_quickness", "vertical", "strength", "stamina"),
}
ATTRIBUTES = tuple(a for group in ATTRIBUTE_GROUPS.values() for a in group)
TRAITS = ("durability", "consistency", "clutch", "hustle", "streaky")
PLACEHOLDER_RATING = 40.0

COMBINE_TESTS = ("THREE_QUARTER_SPRINT", "LANE_AGILITY_TIME", "MODIFIED_LANE_AGILITY_TIME",
                 "MAX_VERTICAL_LEAP", "STANDING_VERTICAL_LEAP", "BENCH_PRESS")
TIME_TESTS = COMBINE_TESTS[:3]
CONTEST_CATEGORIES = ("Overall", "P3", "P2", "R")


@dataclass(frozen=True)
class Stat:
    name: str
    family: str        # beta | gamma
    x: str
    n: str
    kind: str = "attribute"


def _beta(name, x, n, kind="attribute"):
    return Stat(name, "beta", x, n, kind)


def _gamma(name, x, n=OFF100, kind="attribute"):
    return Stat(name, "gamma", x, n, kind)


TENDENCIES = (
    _beta("three_point_attempt_rate", "FG3A", "FGA", "tendency"),
    _beta("mid_range_attempt_rate", "CHART_MID_FGA", "CHART_FGA", "tendency"),
    _beta("rim_attempt_rate", "CHART_RIM_FGA", "CHART_FGA", "tendency"),
    _beta("catch_and_shoot_vs_pull_up", "PU_FGA", "CS_FGA + PU_FGA", "tendency"),
    _beta("shot_clock_usage", "LATE_CLOCK_FGA", "FGA", "tendency"),
    _beta("isolation_frequency", "SYN_Isolation_POSS", "SYN_TOTAL_POSS", "tendency"),
    _beta("post_up_frequency", "SYN_Postup_POSS", "SYN_TOTAL_POSS", "tendency"),
    _beta("pick_and_roll_usage", "SYN_PRBallHandler_POSS", "SYN_TOTAL_POSS", "tendency"),
    _beta("drive_and_kick_vs_drive_to_finish", "DRIVE_PASSES", "DRIVE_PASSES + DRIVE_FGA", "tendency"),
    _beta("pass_first_vs_score_first", "PASSES_MADE", "PASSES_MADE + FGA", "tendency"),
    _beta("foul_contact_seeking", "FTA", "FGA + FTA", "tendency"),
    _beta("cutting_frequency", "SYN_Cut_POSS", "SYN_TOTAL_POSS", "tendency"),
    _beta("screen_setting_willingness", "SCREEN_ASSISTS", "OFF_POSS", "tendency"),
    _beta("gamble_for_steals", "DEFLECTIONS", "DEF_POSS", "tendency"),
    _beta("defensive_foul_aggression", "PF", "DEF_POSS", "tendency"),
    _beta("offensive_rebound_crash_rate", "OREB_CHANCES", "team_missed_fga", "tendency"),
    _beta("box_out_vs_leak_out", "DEF_BOXOUTS", "opp_missed_fga + opp_missed_final_ft", "tendency"),
    _beta("fast_break_leak_out", "SYN_Transition_POSS", "SYN_TOTAL_POSS", "tendency"),
    _beta("loose_ball_willingness", "LOOSE_BALLS_RECOVERED", "OFF_POSS + DEF_POSS", "tendency"),
    _beta("charge_taking_willingness", "CHARGES_DRAWN", "DEF_POSS", "tendency"),
)

ALL_REBOUNDS = "team_oreb + team_dreb + opp_oreb + opp_dreb"
CREATION_POSS = "SYN_Isolation_POSS + SYN_PRBallHandler_POSS"
CREATION_PTS = "SYN_Isolation_PTS + SYN_PRBallHandler_PTS"

STATISTICS = (
    _beta("FT%", "FTM", "FTA"),
    _beta("FOUL%", "shooting_fouls", "A_Overall + shooting_fouls"),
    _beta("BLK%", "pbp_blocks", "opp_fg2a"),
    _beta("STL%", "STL", "DEF_POSS"),
    _beta("OREB conversion", "TRK_OREB", "OREB_CHANCES - OREB_CHANCE_DEFER"),
    _beta("ORB%", "OREB", "team_oreb + opp_dreb"),
    _beta("DREB conversion", "TRK_DREB", "DREB_CHANCES - DREB_CHANCE_DEFER"),
    _beta("DRB%", "DREB", "team_dreb + opp_oreb"),
    _beta("AST% (teammates' FGM on floor)", "AST", "team_fgm - FGM", "trait"),
    _beta("TRB% (all rebounds on floor)", "OREB + DREB", ALL_REBOUNDS, "trait"),
    _beta("contested shots / opponent FGA on floor", "CONTESTED_SHOTS", "opp_fga", "trait"),
    _beta("OREB_CHANCES / team missed FGA on floor", "OREB_CHANCES", "team_missed_fga", "trait"),
    _beta("durability: games missed / roster games", "games_missed", "roster_games", "trait"),
    _gamma("Offensive Load per100", f"OFF_LOAD * ({OFF100})"),
    _gamma("creation possessions per100", CREATION_POSS),
    _gamma("DRIVES per100", "DRIVES"),
    _gamma("AST_ADJ per100", "AST_ADJ"),
    _gamma("DRIVING_LAYUP FGA per100", "LAYUP_FGA"),
    _gamma("DRIVE_FTA per100", "DRIVE_FTA"),
    _gamma("DRIVING_DUNK makes per100", "DRIVING_DUNK_FGM"),
    _gamma("STANDING_DUNK makes per100", "STANDING_DUNK_FGM"),
    _gamma("TOUCH FGA per100", "TOUCH_FGA"),
    _gamma("Postup PPP", "SYN_Postup_PTS", "SYN_Postup_POSS"),
    _gamma("Postup possessions per100", "SYN_Postup_POSS"),
    _gamma("3PA per100", "FG3A"),
    _gamma("Mid-Range FGA per100", "CHART_MID_FGA"),
    _gamma("creation PPP", CREATION_PTS, CREATION_POSS),
    _gamma("PASSES_MADE per100", "PASSES_MADE"),
    _gamma("POTENTIAL_AST per100", "POTENTIAL_AST"),
    _gamma("AST_POINTS_CREATED per100", "AST_POINTS_CREATED"),
    _gamma("SCREEN_ASSISTS per100", "SCREEN_ASSISTS"),
    _gamma("SCREEN_AST_PTS per100", "SCREEN_AST_PTS"),
    _gamma("Cut+OffScreen+Handoff PTS per100", "SYN_Cut_PTS + SYN_OffScreen_PTS + SYN_Handoff_PTS"),
    _gamma("OREB_CHANCES per100", "OREB_CHANCES"),
    _gamma("OFF_LOOSE_BALLS_RECOVERED per100", "OFF_LOOSE_BALLS_RECOVERED"),
    _gamma("OFF_BOXOUTS per100", "OFF_BOXOUTS"),
    _gamma("above-rim makes per100", "DRIVING_DUNK_FGM + STANDING_DUNK_FGM"),
    _gamma("DREB_CHANCES per100", "DREB_CHANCES", DEF100),
    _gamma("DEF_LOOSE_BALLS_RECOVERED per100", "DEF_LOOSE_BALLS_RECOVERED", DEF100),
    _gamma("DEF_BOXOUTS per100", "DEF_BOXOUTS", DEF100),
    _gamma("D_FGA Overall per100", "A_Overall", DEF100),
    _gamma("D_FGA P3 per100", "A_P3", DEF100),
    _gamma("D_FGA P2 per100", "A_P2", DEF100),
    _gamma("D_FGA R per100", "A_R", DEF100),
    _gamma("BLK per100", "pbp_blocks", DEF100),
    _gamma("deflections per100", "DEFLECTIONS", DEF100),
    _gamma("charges drawn per100", "CHARGES_DRAWN", DEF100),
    _gamma("contested shots per100", "CONTESTED_SHOTS", DEF100),
    _gamma("defensive Postup PPP", "SYN_D_Postup_PTS", "SYN_D_Postup_POSS"),
    _gamma("defensive Postup possessions per100", "SYN_D_Postup_POSS", DEF100),
    _gamma("STOP per100", "STL + offensive_fouls_drawn + pbp_blocks_recovered", DEF100),
    _gamma("non-shooting defensive fouls per100", "nonshooting_def_fouls", DEF100),
    _gamma("loose balls recovered per100 DEFPOSS", "LOOSE_BALLS_RECOVERED", DEF100),
    _gamma("loose balls per100 total possessions", "LOOSE_BALLS_RECOVERED", "(OFF_POSS + DEF_POSS) / 100.0", "trait"),
)
ALL_SHRUNK = (*TENDENCIES, *STATISTICS)


@dataclass(frozen=True)
class Part:
    """One component of a score: ``weight * transform(sign * stat)``.

    transform: ``Z`` normal score, ``z`` standard score, ``raw`` the value, ``log`` recorded only.
    """

    field: str
    component: str
    stat: str
    weight: float = 1.0
    transform: str = "Z"
    sign: float = 1.0


def _mean(field, parts, total=1.0, transform="Z"):
    return [Part(field, name, stat, total / len(parts), transform, sign)
            for name, stat, sign in ((*p, 1.0) if len(p) == 2 else p for p in parts)]


def _rebounding(field, share, conversion, volumes):
    return [*_mean(field, [("conversion*", conversion), (share + "*", share)], 0.5),
            *_mean(field, [(v, v) for v in volumes], 0.5)]


REBOUND_FALLBACK = {"offensive_rebounding": "ORB%", "defensive_rebounding": "DRB%"}

COMPONENTS = (
    *_mean("driving_layup", [("efficiency d*", "E1 DRIVING_LAYUP d"), ("attempts per100", "DRIVING_LAYUP FGA per100"),
                             ("drive FTA per100", "DRIVE_FTA per100")]),
    Part("driving_dunk", "makes per100", "DRIVING_DUNK makes per100"),
    Part("standing_dunk", "makes per100", "STANDING_DUNK makes per100"),
    *_mean("touch", [("efficiency d*", "E1 TOUCH d"), ("attempts per100", "TOUCH FGA per100"), ("FT%*", "FT%")]),
    *_mean("post_scoring", [("PPP*", "Postup PPP"), ("possessions per100", "Postup possessions per100")]),
    *_mean("three_pointer", [("efficiency d*", "E2 3P d"), ("3PA per100", "3PA per100"), ("FT%*", "FT%")]),
    *_mean("mid_range", [("efficiency d*", "E1 Mid-Range d"), ("attempts per100", "Mid-Range FGA per100"),
                         ("FT%*", "FT%")]),
    Part("free_throw", "FT%*", "FT%", 1.0, "raw"),
    *_mean("ball_handle", [("handling turnovers RR*", "E3 handling turnovers", -1.0), ("creation PPP*", "creation PPP")],
           2 / 3),
    *_mean("ball_handle", [("creation per100", "creation possessions per100"),
                           ("Offensive Load per100", "Offensive Load per100"), ("drives per100", "DRIVES per100")],
           1 / 3),
    *_mean("passing_accuracy", [("bad-pass turnovers RR*", "E3 bad-pass turnovers", -1.0)], 0.5),
    *_mean("passing_accuracy", [("passes per100", "PASSES_MADE per100"), ("AST_ADJ per100", "AST_ADJ per100")], 0.5),
    *_mean("vision", [("assisted-shot quality d*", "assisted-shot quality d")], 0.5),
    *_mean("vision", [("potential assists per100", "POTENTIAL_AST per100"), ("AST_ADJ per100", "AST_ADJ per100"),
                      ("AST_POINTS_CREATED per100", "AST_POINTS_CREATED per100")], 0.5),
    *_rebounding("offensive_rebounding", "ORB%", "OREB conversion",
                 ("OREB_CHANCES per100", "OFF_LOOSE_BALLS_RECOVERED per100", "OFF_BOXOUTS per100")),
    *_rebounding("defensive_rebounding", "DRB%", "DREB conversion",
                 ("DREB_CHANCES per100", "DEF_LOOSE_BALLS_RECOVERED per100", "DEF_BOXOUTS per100")),
    *_mean("steals", [("STL%*", "STL%"), ("deflections per100", "deflections per100")]),
    *_mean("shot_blocking", [("RR_BLK*", "RR_BLK")], 0.5),
    *_mean("shot_blocking", [("BLK%*", "BLK%"), ("BLK per100*", "BLK per100")], 0.5),
    *[Part("on_ball_defense", name, stat, 0.0, "log") for name, stat in (
        ("delta_P3*", "delta_P3"), ("delta_P2*", "delta_P2"), ("D_FGA P3 per100*", "D_FGA P3 per100"),
        ("D_FGA P2 per100*", "D_FGA P2 per100"), ("perimeter foul cost", "perimeter foul cost"))],
    Part("on_ball_defense", "net perimeter points saved per100", "net perimeter points saved", 1.0, "raw"),
    Part("post_defense", "PPP allowed*", "defensive Postup PPP", 0.0, "log"),
    Part("post_defense", "possessions per100*", "defensive Postup possessions per100", 0.0, "log"),
    Part("post_defense", "points saved per100", "post points saved", 1.0, "raw"),
    Part("rim_protection", "contest (A_R* x delta_R*)", "rim contest", 0.0, "log"),
    Part("rim_protection", "deterrence", "rim deterrence", 0.0, "log"),
    Part("rim_protection", "rim foul cost", "rim foul cost", 0.0, "log"),
    Part("rim_protection", "net rim points saved per100", "net rim points saved", 1.0, "raw"),
    *_mean("off_ball_defense", [("help contests (residual)", "help contests residual"), ("BLK per100*", "BLK per100"),
                                ("deflections per100*", "deflections per100"),
                                ("charges drawn per100*", "charges drawn per100")]),
    *_mean("speed", [("-z(THREE_QUARTER_SPRINT)", "THREE_QUARTER_SPRINT", -1.0),
                     ("z(AVG_SPEED_OFF residual)", "AVG_SPEED_OFF residual")], 1.0, "z"),
    *_mean("acceleration", [("-z(THREE_QUARTER_SPRINT)", "THREE_QUARTER_SPRINT", -1.0),
                            ("-z(MODIFIED_LANE_AGILITY_TIME)", "MODIFIED_LANE_AGILITY_TIME", -1.0),
                            ("z(STANDING_VERTICAL_LEAP)", "STANDING_VERTICAL_LEAP"),
                            ("z(DRIVES per100 residual)", "DRIVES per100 residual")], 1.0, "z"),
    *_mean("lateral_quickness", [("-z(LANE_AGILITY_TIME)", "LANE_AGILITY_TIME", -1.0),
                                 ("-z(MODIFIED_LANE_AGILITY_TIME)", "MODIFIED_LANE_AGILITY_TIME", -1.0),
                                 ("z(AVG_SPEED_DEF residual)", "AVG_SPEED_DEF residual")], 1.0, "z"),
    *_mean("vertical", [("z(MAX_VERTICAL_LEAP)", "MAX_VERTICAL_LEAP"),
                        ("z(STANDING_VERTICAL_LEAP)", "STANDING_VERTICAL_LEAP"),
                        ("z(above-rim finishing residual)", "above-rim residual")], 1.0, "z"),
    *_mean("strength", [("z(WEIGHT)", "WEIGHT"), ("z(BENCH_PRESS)", "BENCH_PRESS")], 1.0, "z"),
    *_mean("trait:hustle", [("deflections per100", "deflections per100"),
                            ("loose balls per100 total possessions", "loose balls per100 total possessions"),
                            ("charges drawn per100", "charges drawn per100"),
                            ("screen assists per100", "SCREEN_ASSISTS per100"),
                            ("contested shots share", "contested shots / opponent FGA on floor"),
                            ("offensive-rebound crash rate", "OREB_CHANCES / team missed FGA on floor")]),
)

# Blended scores: component, statistic, sign; the weights come from the fit to ``target``.
BLENDS = {
    "offensive_iq": ("RAPM offense", 1.0, (
        ("shot-choice value d*", "shot-choice value d", 1.0),
        ("decision turnovers RR* (negated)", "E3 decision turnovers", -1.0),
        ("SCREEN_ASSISTS per100", "SCREEN_ASSISTS per100", 1.0),
        ("SCREEN_AST_PTS per100", "SCREEN_AST_PTS per100", 1.0),
        ("Cut+OffScreen+Handoff points per100", "Cut+OffScreen+Handoff PTS per100", 1.0),
        ("assisted-shot quality d*", "assisted-shot quality d", 1.0),
        ("AST_ADJ per100", "AST_ADJ per100", 1.0),
        ("Box Creation per100", "Box Creation per100", 1.0))),
    "defensive_iq": ("RAPM defense", -1.0, (
        ("shot-quality suppression (negated defense coefficient)", "shot-quality defense", -1.0),
        ("STOP per100", "STOP per100", 1.0),
        ("non-shooting defensive fouls per100 (negated)", "non-shooting defensive fouls per100", -1.0),
        ("contested shots per100", "contested shots per100", 1.0),
        ("deflections per100", "deflections per100", 1.0),
        ("charges drawn per100", "charges drawn per100", 1.0),
        ("loose balls recovered per100", "loose balls recovered per100 DEFPOSS", 1.0),
        ("BLK%*", "BLK%", 1.0),
        ("rim delta_R*", "delta_R", 1.0))),
}
STAMINA = (("Z(beta*)", "Stamina beta", "Z"), ("Z(stint length*)", "stint length", "Z"),
           ("z(distance per 48 residual)", "distance per 48 residual", "z"))

# Features of the peer clusters: statistic or measurable.
CLUSTER_FEATURES = ("height", "position index", "Offensive Load per100", "three_point_attempt_rate", "rim_attempt_rate",
                    "AST% (teammates' FGM on floor)", "TRB% (all rebounds on floor)", "BLK%", "STL%")
