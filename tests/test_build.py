"""End to end on a made-up season: gates, invariants, publish, report."""

import pytest
from league_fixture import ACTIONS, raw_tables
from pyspark.sql import functions as F

from tallywright.operators import quality as q
from tallywright.plans import build as bd
from tallywright.plans import specs as sp
from tallywright.plans.profile import Derivation
from tallywright.plans.report import breakdown, find_players
from tallywright.sources.publish import PublishRefused, publish, read_published


@pytest.fixture(scope="module")
def built(spark):
    return bd.build(raw_tables(spark), "2025-26")


def test_every_field_for_every_player(built):
    t = built.tables
    n = t["players"].count()
    assert n == 240
    assert t["player_attributes"].count() == n * len(sp.ATTRIBUTES) and len(sp.ATTRIBUTES) == 27
    assert t["player_tendencies"].count() == n * 20 and t["player_traits"].count() == n * 5
    assert [r["name"] for r in built.profiles.failures.collect()] == []


def test_integrity(built):
    assert bd.integrity_problems(built.tables).collect() == []


def test_lineups_agree_with_official_minutes(built):
    assert built.lineup_quality["n_unresolved"] == 0
    assert built.lineup_quality["minutes_mean_abs_error"] < 0.01


def test_placeholders_only_for_players_without_exposure(built):
    p = built.tables["players"].where("no_data = 1")
    assert p.count() == 30
    a = built.tables["player_attributes"].join(p.select("player_id"), "player_id")
    assert a.select("rating", "placeholder").distinct().collect() == [(40.0, 1)]


def test_ratings_are_99_times_percentile(built):
    a = built.tables["player_attributes"].where("placeholder = 0")
    worst = a.agg(F.max(F.abs(F.col("rating") - 99 * F.col("percentile")))).first()[0]
    assert worst < 1e-9
    mean = a.groupBy("attribute").agg(F.avg("percentile").alias("m")).agg(F.max(F.abs(F.col("m") - 0.5))).first()[0]
    assert mean < 1e-9


def test_blend_weights_sum_to_one(built):
    for r in built.tables["blend_weights"].groupBy("field").agg(F.sum("weight").alias("s"), F.min("weight").alias("m")).collect():
        assert r["s"] == pytest.approx(1.0) and r["m"] >= 0


def test_components_rebuild_scores(built):
    """driving_layup is the mean of its three component scores."""
    c = built.tables["components"].where("field = 'driving_layup'").groupBy("player_id").agg(F.avg("z").alias("mean"))
    s = built.tables["player_attributes"].where("attribute = 'driving_layup' and placeholder = 0")
    gap = c.join(s, "player_id").agg(F.max(F.abs(F.col("mean") - F.col("score"))), F.count(F.lit(1))).first()
    assert gap[0] < 1e-9 and gap[1] == 210


def test_every_statistic_has_one_prior(built):
    priors = built.tables["priors"]
    assert q.repeated_keys(priors, ["kind", "name"]).count() == 0
    names = {r["name"] for r in priors.collect()}
    assert {s.name for s in sp.ALL_SHRUNK} <= names and {"delta_R", "RR_BLK", "Stamina beta"} <= names


def test_depth_chart(built):
    p = built.tables["players"]
    per = p.groupBy("team_id").agg(F.sort_array(F.collect_list("depth_rank")).alias("d"), F.count(F.lit(1)).alias("n"))
    assert all(r["d"] == list(range(1, r["n"] + 1)) for r in per.collect())
    starters = p.where("depth_rank <= 5").agg(F.min("games_started")).first()[0]
    assert starters == 3


def test_shot_table_matches_the_log(built):
    lg = built.league
    assert lg.shots.count() == lg.pbp_shots.count()
    made = lg.shots.agg(F.sum("made")).first()[0]
    assert made == lg.inputs.agg(F.sum("FGM")).first()[0]
    assert {r[0] for r in lg.shots.select("action_type").distinct().collect()} == {a[0] for a in ACTIONS}


def test_on_floor_totals_are_five_times_the_events(built):
    lg = built.league
    fga = lg.inputs.agg(F.sum("FGA"), F.sum("team_fga"), F.sum("opp_fga")).first()
    assert fga[1] == 5 * fga[0] and fga[2] == 5 * fga[0]


def test_publish_is_all_or_nothing(built, spark, tmp_path):
    root = str(tmp_path / "out")
    small = {k: built.tables[k] for k in ("players", "blend_weights", "meta")}
    bad = spark.createDataFrame([("tendency", "x", "abort", "7 (5 of 4)")], "kind string, name string, status string, message string")
    with pytest.raises(PublishRefused, match="7 \\(5 of 4\\)"):
        publish(small, root, bad)
    assert not (tmp_path / "out").exists()
    publish(small, root, built.profiles.failures)
    assert read_published(spark, root, "players").count() == 240


def test_report(built):
    rows = breakdown(built.tables, "l1003").collect()
    assert {r["player_id"] for r in rows} == {1003}
    assert {r["section"] for r in rows} == {*sp.ATTRIBUTE_GROUPS, "Tendencies", "Traits"}
    assert sum(r["weight"] is not None for r in rows) == 17
    assert find_players(built.tables["players"], "1003").count() == 1


def test_impossible_count_names_the_player(built):
    lg = built.league
    lg2 = bd.League(**{**lg.__dict__, "inputs": lg.inputs.withColumn("FTM", F.when(
        F.col("player_id") == 1001, F.col("FTA") + 3).otherwise(F.col("FTM")))})
    d = Derivation(lg2, models=False)
    d.counts()
    assert "1001" in d.stat_errors["FT%"] and d.stat_errors["FT%"].startswith("guard")
    assert set(d.stat_errors) == {"FT%"}


def test_a_source_without_a_column_is_named(spark):
    from tallywright.plans.assemble import REQUIRED, check_contracts
    from tallywright.sources.payloads import MissingColumns

    def empty(columns):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))

    raw = {name: empty(columns) for name, columns in REQUIRED.items() if name not in ("contests", "inactive")}
    raw["contests"] = {c: empty(REQUIRED["contests"]) for c in ("Overall", "R")}
    raw["seasons"] = (raw["box"], empty(REQUIRED["inactive"]))
    check_contracts(raw | {"rotation": None, "pt_Rebounding": raw["pt_Rebounding"].drop("OREB_CHANCES")})
    for name, column in (("text_log", "description"), ("id_log", "personId"), ("rotation", "IN_TIME_REAL"), ("player_index", "HEIGHT"), ("synergy", "POSS")):
        with pytest.raises(MissingColumns, match=f"{name}: missing columns .*{column}"):
            check_contracts(raw | {name: raw[name].drop(column)})
    with pytest.raises(MissingColumns, match="contests R"):
        check_contracts(raw | {"contests": {"R": empty(["OTHER"])}})
    with pytest.raises(MissingColumns, match="seasons inactive"):
        check_contracts(raw | {"seasons": (raw["box"], empty(["game_id"]))})
