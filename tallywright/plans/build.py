"""End to end: raw tables -> league -> profiles -> result tables, behind one gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.scalars import split_display_name
from tallywright.operators import quality as q
from tallywright.operators.ranks import depth_rank
from tallywright.plans import specs as sp
from tallywright.plans.assemble import assemble
from tallywright.plans.game_log import totals_row
from tallywright.plans.profile import ID, League, Profiles, derive_profiles, union_all
from tallywright.sources.publish import publish

# Fields with a status but no score.
OTHER_STATUS = (
    ("measurable", "height_in", "derived", "listed height, second source where blank"),
    ("measurable", "weight_lb", "derived", "listed weight, second source where blank"),
    ("measurable", "wingspan_in", "derived", "measured, else a + b * height"),
    ("player_field", "position", "derived", "published label"),
    ("player_field", "contract", "empty", "nullable; no source"),
    ("player_field", "depth_rank", "derived", "top five by games started, then minutes per game"),
)
TEAMS_EXPECTED = 30


class LineupsUnreliable(RuntimeError):
    """Too many counted events without two known lineups."""


@dataclass
class Built:
    league: League
    profiles: Profiles
    tables: dict
    lineup_quality: dict


def lineup_quality(lg: League) -> dict:
    """Unresolved share and agreement of rebuilt with official minutes; refuses a broken rebuild."""
    games = lg.extra["game_tables"]
    share = q.unresolved_share(totals_row(games), "events_total", "events_unresolved").first()
    official = lg.extra["box_minutes"].where(F.col("minutes") > 0).select(
        "game_id", F.col("person_id").alias("player_id"), "minutes")
    rebuilt = games.seconds.select("game_id", "player_id", (F.col("seconds") / 60.0).alias("rebuilt"))
    gap = q.minutes_agreement(official.join(rebuilt, ["game_id", "player_id"], "left"), "rebuilt", "minutes").first()
    out = {**share.asDict(), **{f"minutes_{k}": v for k, v in gap.asDict().items()}}
    if not out["ok"]:
        raise LineupsUnreliable(f"{out['share']:.2%} of counted events have no known lineup")
    return out


def players_table(lg: League, profiles: Profiles) -> DataFrame:
    """Names, measurables, usage with the final team, depth and flags."""
    use = lg.extra["usage"]
    r = lg.roster.join(use, [ID, "team_id"], "left").na.fill(0, ["games_played", "games_started", "minutes"])
    per = F.when(F.col("games_played") > 0, F.col("minutes") / F.col("games_played")).otherwise(0.0)
    ranked = depth_rank(r.withColumn("minutes_per_game", per), "team_id", ID, "games_started", "minutes_per_game")
    first, last = split_display_name("display_name")
    named = ranked.join(lg.extra["names"].withColumn("__seen", F.lit(True)), ID, "left")
    exposed = profiles.population.withColumn("__exposed", F.lit(1))
    out = named.join(exposed, ID, "left").withColumn("no_data", F.when(F.col("__exposed").isNull(), 1).otherwise(0))
    seen = F.coalesce("__seen", F.lit(False))
    return out.select(
        ID, "team_id", F.when(seen, F.col("first_name")).otherwise(first).alias("first_name"),
        F.when(seen, F.col("family_name")).otherwise(last).alias("last_name"), "jersey", "position", "position_index",
        "birth_date", "experience", "age", "height_in", "weight_lb", "wingspan_in", "wingspan_imputed", "games_played",
        "games_started", "minutes_per_game", "depth_rank", "no_data", F.col("no_data").alias("placeholder_rating"))


def status_table(profiles: Profiles) -> DataFrame:
    spark = profiles.population.sparkSession
    names = [("attribute", a) for a in sp.ATTRIBUTES] + [("tendency", t.name) for t in sp.TENDENCIES] + [
        ("trait", t) for t in sp.TRAITS]
    fields = spark.createDataFrame(names, "kind string, name string")
    failed = profiles.failures.select("kind", "name", "status", F.col("message").alias("note"))
    scored = fields.join(failed, ["kind", "name"], "left").select(
        "kind", "name", F.coalesce("status", F.lit("derived")).alias("status"), F.coalesce("note", F.lit("")).alias("note"))
    other = spark.createDataFrame(OTHER_STATUS, "kind string, name string, status string, note string")
    return scored.unionByName(other)


def result_tables(lg: League, profiles: Profiles, quality: dict, season: str) -> dict:
    spark = profiles.population.sparkSession
    wing = lg.extra["wingspan_fit"]
    players = players_table(lg, profiles)
    meta = {"season": season, "placeholder_rating": "40.0", "pbp_events": quality["n_events"],
            "pbp_events_unresolved": quality["n_unresolved"], "pbp_unresolved_share": f"{quality['share']:.6f}",
            "lineup_minutes_mean_abs_error": f"{quality['minutes_mean_abs_error'] or 0:.4f}",
            "wingspan_fit": f"a={wing['a']:.6f};b={wing['b']:.6f};n={wing['n']}",
            "complete": "0" if profiles.failures.limit(1).count() else "1"}
    empty = "player_id bigint, salary double, years_remaining int"
    return {
        "meta": spark.createDataFrame([(k, str(v)) for k, v in sorted(meta.items())], "key string, value string"),
        "teams": lg.extra["teams"] if lg.extra["teams"] is not None else lg.roster.select("team_id").distinct(),
        "players": players, "player_attributes": profiles.attributes, "player_tendencies": profiles.tendencies,
        "player_traits": profiles.traits, "contracts": spark.createDataFrame([], empty),
        "derivation_status": status_table(profiles),
        "priors": profiles.priors.withColumnRenamed("n_entities", "n_players"),
        "components": profiles.components, "blend_weights": profiles.weights, "model_parameters": profiles.parameters,
        "build_notes": profiles.notes, "data_checks": lg.extra["checks"], "games": lg.extra["games"],
        "team_season_stats": lg.extra["team_stats"],
    }


def build(raw: dict, season: str = "") -> Built:
    lg = assemble(raw)
    quality = lineup_quality(lg)
    profiles = derive_profiles(lg)
    return Built(lg, profiles, result_tables(lg, profiles, quality, season), quality)


def build_and_publish(raw: dict, root: str, season: str = "", allow_incomplete: bool = False) -> str:
    built = build(raw, season)
    return publish(built.tables, root, built.profiles.failures, allow_incomplete)


# ------------------------------------------------------------------ reading a result
def completeness_report(tables: dict) -> DataFrame:
    """Per field: players with a value, all players, status (``missing`` without a status row)."""
    players = tables["players"]
    flags = players.select(ID, "no_data")
    a = tables["player_attributes"].select(ID, F.lit("attribute").alias("kind"), F.col("attribute").alias("name"),
                                           F.col("rating").isNotNull().cast("int").alias("present"))
    t = tables["player_tendencies"].select(ID, F.lit("tendency").alias("kind"), F.col("tendency").alias("name"),
                                           F.col("value").isNotNull().cast("int").alias("present"))
    ok = F.col("z_score").isNotNull() & F.col("tier").isNotNull() & (F.col("value").isNotNull() | (F.col("no_data") == 1))
    tr = tables["player_traits"].join(flags, ID).select(ID, F.lit("trait").alias("kind"), F.col("trait").alias("name"),
                                                        ok.cast("int").alias("present"))
    body = players.unpivot([ID], ["height_in", "weight_lb", "wingspan_in"], "name", "v").select(
        ID, F.lit("measurable").alias("kind"), "name", F.col("v").isNotNull().cast("int").alias("present"))
    spot = players.select(ID, F.lit("player_field").alias("kind"), F.lit("position").alias("name"),
                          F.col("position").isNotNull().cast("int").alias("present"))
    deal = tables["contracts"].select(ID, F.lit("player_field").alias("kind"), F.lit("contract").alias("name"),
                                      F.lit(1).alias("present"))
    names = ([("attribute", x) for x in sp.ATTRIBUTES] + [("tendency", x.name) for x in sp.TENDENCIES]
             + [("trait", x) for x in sp.TRAITS] + [("measurable", x) for x in ("height_in", "weight_lb", "wingspan_in")]
             + [("player_field", "position"), ("player_field", "contract")])
    fields = players.sparkSession.createDataFrame(names, "kind string, name string")
    return q.completeness(players, union_all([a, t, tr, body, spot, deal]), fields, ID,
                          tables["derivation_status"].select("kind", "name", "status", "note"))


def integrity_problems(tables: dict) -> DataFrame:
    """Everything that makes a published league unloadable, one row per problem; empty = loadable."""
    p = tables["players"]
    from tallywright.functions.scalars import position_index
    report = completeness_report(tables)
    known = report.select("kind", "name")
    facts = union_all([tables[t].select(F.lit(k).alias("kind"), F.col(k).alias("name")) for t, k in (
        ("player_attributes", "attribute"), ("player_tendencies", "tendency"), ("player_traits", "trait"))])

    def row(df, problem, subject):
        return df.select(F.lit(problem).alias("problem"), subject.cast("string").alias("subject"))

    teams = p.agg(F.countDistinct("team_id").alias("n"))
    ratings = tables["player_attributes"].select(ID, "rating")
    return union_all([
        row(report.where((F.col("complete") == 0) & (F.col("name") != "contract")), "field incomplete", F.col("name")),
        row(report.where(F.col("status") == "missing"), "field without status", F.col("name")),
        row(q.unknown_fields(facts, known), "unknown field", F.col("name")),
        row(teams.where(F.col("n") != TEAMS_EXPECTED), "team count", F.col("n")),
        row(p.where(position_index("position", strict=False).isNull() | (
            position_index("position", strict=False) != F.col("position_index"))), "position index", F.col(ID)),
        row(q.flag_mismatch(p, ratings, ID, sp.PLACEHOLDER_RATING), "placeholder flags", F.col(ID)),
        row(q.out_of_range(tables["player_attributes"], [ID], "rating", 0, 99), "rating out of range", F.col(ID)),
        row(q.out_of_range(tables["player_tendencies"], [ID], "value", 0, 1), "tendency out of range", F.col(ID)),
        row(q.out_of_range(tables["player_traits"], [ID], "tier", -2, 2), "tier out of range", F.col(ID)),
        row(q.repeated_keys(p, [ID]), "player repeated", F.col(ID)),
        row(q.orphans(tables["player_attributes"], p, ID, ID), "attribute without player", F.col(ID)),
        row(q.orphans(tables["player_tendencies"], p, ID, ID), "tendency without player", F.col(ID)),
        row(q.orphans(tables["player_traits"], p, ID, ID), "trait without player", F.col(ID)),
    ])
