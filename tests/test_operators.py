"""Operators on small fixtures: edge rules, agreement of the chunked and the plain plans, payloads."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright.functions import scalars as sc
from tallywright.operators import ordered, quality, ranks, sequences, shrinkage
from tallywright.sources import payloads as pl


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_probit_matches_the_normal_distribution(spark):
    ps = [1e-12, 1e-6, 0.02425, 0.075, 0.3, 0.5, 0.7, 0.925, 0.999999]
    got = [r["z"] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(sc.probit("p").alias("z")).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-9)
    assert one(spark, sc.probit(F.lit(0.0))) is None


@pytest.mark.parametrize("text,minutes", [("34:12", 34.2), ("PT34M12.00S", 34.2), ("34.2", 34.2), ("", 0.0), (None, 0.0)])
def test_minutes(spark, text, minutes):
    assert one(spark, sc.minutes_value(F.lit(text).cast("string"))) == pytest.approx(minutes)


@pytest.mark.parametrize("clock,period,t", [("PT12M00.00S", 1, 0), ("PT07M00.00S", 1, 3000), ("PT00M00.00S", 4, 28800), ("PT05M00.00S", 5, 28800)])
def test_clock(spark, clock, period, t):
    assert one(spark, sc.clock_tenths(F.lit(clock), F.lit(period))) == t


def test_broken_texts_are_errors(spark):
    for bad in (sc.clock_tenths(F.lit("7:00"), F.lit(1)), sc.turnover_class(F.lit(" ")), sc.position_index(F.lit("PG"))):
        with pytest.raises(PySparkException):
            one(spark, bad)


def test_final_free_throw(spark):
    """Live is the last of a trip (n of n), whatever the case, unless the trip is of a kind after which the ball is dead."""
    trips = [(f"free throw {i} OF {n}", i == n) for n in (1, 2, 3) for i in range(1, n + 1)]
    dead = [(f"{kind} {n} of {n}", False) for kind in sc.DEAD_BALL_FREE_THROWS for n in (1, 3)]
    texts = [*trips, *dead, ("3 of 4 of 4", False), ("of", False), ("", False), (None, False)]
    rows = spark.createDataFrame(texts, "text string, live boolean").withColumn("got", sc.is_reboundable_final_ft("text")).collect()
    assert [(r.text, r.got) for r in rows] == texts


@pytest.mark.parametrize("text,names", [("SUB: Ola Nord FOR Eva Syd", ("Ola Nord", "Eva Syd")), ("SUB:A\t FOR  B ", ("A", "B")), ("SUB: A FOR B FOR C", ("A", "B FOR C")), ("SUB: A", (None, None)),
                                        ("SUB:  FOR B", (None, None)), ("a SUB: A FOR B", (None, None)), ("SUB: A FORMER B", (None, None)), (None, (None, None))])
def test_substitution_text(spark, text, names):
    assert tuple(one(spark, c) for c in sc.substitution_names(F.lit(text).cast("string"))) == names


@pytest.mark.parametrize("text,name", [("Syd 3' Layup (2 PTS) (Ola Nord 7 AST)", "Ola Nord"), ("(A 1 AST) (B 2 AST)", "A"), ("(7 AST)", None), ("A 1 AST)", None), ("(A 1 AST", None), ("(A x AST)", None),
                                       ("", None), (None, None)])
def test_helper_text(spark, text, name):
    assert one(spark, sc.assist_name(F.lit(text).cast("string"))) == name


def test_names_fold_accents(spark):
    assert one(spark, sc.norm_name(F.lit("Jokić, Nikola ß Ǆ"))) == "jokicnikoladz"


def test_tier_bounds(spark):
    zs = [-2.0, -1.99, -1.0, -0.99, 0.99, 1.0, 1.99, 2.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(sc.tier("z")).collect()]
    assert got == [-2, -1, -1, 0, 0, 1, 1, 2]


# ------------------------------------------------------------------ ordered passes
@pytest.fixture(scope="module")
def stream(spark):
    rng = np.random.default_rng(1)
    rows = [(0 if rng.random() < 0.6 else int(rng.integers(1, 6)), int(rng.integers(0, 400)), i, None if rng.random() < 0.5 else int(rng.integers(9)))
            for i in range(3000)]
    return spark.createDataFrame(rows, "k int, t int, i int, v int").persist()


def test_chunked_scan_equals_plain(stream):
    cuts = ordered.plan_cuts(stream, ["k"], "t", 100)
    assert len(cuts.points) > 5
    outs = {"s": ("sum", "v"), "sb": ("sum_before", "v"), "l": ("last", "v"), "lb": ("last_before", "v"), "p": ("previous", "v"), "m": ("max", "v"), "f": ("first", "v")}
    plain = ordered.ordered_scan(stream, ["k"], ["t", "i"], outs)
    cut = ordered.ordered_scan(stream, ["k"], ["t", "i"], outs, cuts)
    plain = plain.withColumn("s", F.coalesce("s", F.lit(0)))      # a sum over only NULLs
    cut = cut.withColumn("s", F.coalesce("s", F.lit(0)))
    assert plain.exceptAll(cut.select(plain.columns)).count() == 0 and cut.count() == 3000


def test_text_order_is_cut_after_the_shared_prefix(spark):
    df = spark.createDataFrame([(1, f"2025-10-{d:02d}", i) for d in range(1, 29) for i in range(20)], "k int, d string, i int")
    cuts = ordered.plan_cuts(df, ["k"], "d", 50)
    assert cuts.skip == len("2025-10-") and len(cuts.points) > 5
    plain = ordered.ordered_scan(df, ["k"], ["d", "i"], {"n": ("sum", F.lit(1))})
    cut = ordered.ordered_scan(df, ["k"], ["d", "i"], {"n": ("sum", F.lit(1))}, cuts)
    assert plain.exceptAll(cut.select(plain.columns)).count() == 0


def test_row_index_is_dense_when_cut(stream):
    got = ordered.row_index(stream, ["t", "i"], limit=200)
    want = {(r["t"], r["i"]): n for n, r in enumerate(sorted(stream.collect(), key=lambda r: (r["t"], r["i"])))}
    assert all(want[(r["t"], r["i"])] == r["row_index"] for r in got.collect())


def test_mid_rank_with_a_hot_statistic(stream):
    df = stream.where("v is not null").withColumn("x", F.col("v") * 1.0 + F.col("t") / 1000)
    plain = ranks.mid_rank(df, ["k"], "x").collect()
    cut = ranks.mid_rank(df, ["k"], "x", limit=50).collect()
    key = lambda r: (r["i"], round(r["percentile"], 12))
    assert sorted(map(key, plain)) == sorted(map(key, cut))
    xs = np.array([r["x"] for r in plain if r["k"] == 0])
    for r in plain:
        if r["k"] == 0:
            assert r["percentile"] == pytest.approx(((xs < r["x"]).sum() + 0.5 * (xs == r["x"]).sum()) / len(xs))


def test_runs_test_cut_and_plain(stream):
    rows = stream.where("v is not null")
    a = sequences.runs_test(rows, "k", ["t", "i"], F.col("v") > 4)
    b = sequences.runs_test(rows, "k", ["t", "i"], F.col("v") > 4, limit=60)
    assert a.exceptAll(b).count() == 0
    made = [r["v"] > 4 for r in sorted(rows.where("k = 0").collect(), key=lambda r: (r["t"], r["i"]))]
    runs = 1 + sum(x != y for x, y in zip(made, made[1:]))
    assert a.where("k = 0").first()["runs"] == runs


def test_depth_rank_hot_group(spark):
    df = spark.createDataFrame([(1, i, i % 7, float(i % 13)) for i in range(300)], "g int, e int, s int, a double")
    a, b = ranks.depth_rank(df, "g", "e", "s", "a"), ranks.depth_rank(df, "g", "e", "s", "a", limit=40)
    assert a.exceptAll(b.select(a.columns)).count() == 0
    rows = sorted(df.collect(), key=lambda r: (-r["s"], -r["a"], r["e"]))
    later = sorted(rows[5:], key=lambda r: (-r["a"], -r["s"], r["e"]))
    assert {r["e"]: r["depth_rank"] for r in a.collect()} == {r["e"]: i + 1 for i, r in enumerate(rows[:5] + later)}


def test_runs_without_spread_are_zero(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 0)], "k int, t int, y int")
    assert {r["k"]: r["z_runs"] for r in sequences.runs_test(df, "k", ["t"], F.col("y") == 1).collect()} == {1: 0.0, 2: 0.0}


def test_standard_score_without_spread(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("b", 1.0), ("b", 3.0)], "g string, v double")
    assert sorted(r["z"] for r in ranks.standard_score(df, ["g"], "v").collect()) == [-1.0, 0.0, 0.0, 1.0]


def test_interval_join_against_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = [(int(rng.integers(3)), float(rng.random() * 100), i) for i in range(300)]
    spans = [(int(rng.integers(3)), float(s), float(s + rng.random() * 30), i) for i, s in enumerate(rng.random(60) * 100)]
    got = sequences.interval_join(spark.createDataFrame(pts, "k int, at double, p int"), spark.createDataFrame(spans, "k int, a double, b double, s int"),
                                  ["k"], "at", "a", "b", 7.0)
    want = {(p[2], s[3]) for p in pts for s in spans if p[0] == s[0] and s[1] <= p[1] < s[2]}
    rows = got.collect()
    assert {(r["p"], r["s"]) for r in rows} == want and len(rows) == len(want)


# ------------------------------------------------------------------ shrinkage
def test_beta_recovers_its_prior(spark):
    rng = np.random.default_rng(0)
    p, n = rng.beta(8, 12, 4000), rng.integers(20, 200, 4000)
    df = spark.createDataFrame([("s", float(x), float(k)) for x, k in zip(rng.binomial(n, p), n)], "stat string, x double, n double")
    r = shrinkage.fit_beta(df, ["stat"]).first()
    assert r["param1"] == pytest.approx(8, rel=0.15) and r["param2"] == pytest.approx(12, rel=0.15)


def test_gamma_recovers_its_prior(spark):
    rng = np.random.default_rng(0)
    rate, e = rng.gamma(5, 2 / 5, 4000), rng.uniform(5, 50, 4000)
    df = spark.createDataFrame([("s", float(x), float(k)) for x, k in zip(rng.poisson(rate * e), e)], "stat string, x double, n double")
    r = shrinkage.fit_gamma(df, ["stat"]).first()
    assert r["param1"] == pytest.approx(5, rel=0.15) and r["mean"] == pytest.approx(2, rel=0.05)


def test_edge_rules_of_the_fits(spark):
    df = spark.createDataFrame([("guard", 5.0, 4.0), ("guard", 1.0, 4.0), ("few", 1.0, 2.0), ("few", 0.0, 0.0), ("flat", 5.0, 10.0), ("flat", 5.0, 10.0),
                                ("zero", 0.0, 3.0), ("zero", 0.0, 4.0)], "stat string, x double, n double")
    fit = {r["stat"]: r for r in shrinkage.fit_beta(df, ["stat"]).collect()}
    assert fit["guard"]["error"].startswith("guard") and "fewer" in fit["few"]["error"] and "degenerate" in fit["zero"]["error"]
    assert fit["flat"]["error"] is None and fit["flat"]["param1"] is None and fit["flat"]["mean"] == 0.5
    gamma = {r["stat"]: r for r in shrinkage.fit_gamma(df.where("stat = 'zero'"), ["stat"]).collect()}
    assert gamma["zero"]["error"] == "mean rate is zero"
    out = shrinkage.shrink_beta(df, shrinkage.fit_beta(df, ["stat"]), ["stat"])
    assert {r["stat"]: r["value"] for r in out.collect()}["flat"] == 0.5


def test_normal_without_attempts_gets_the_mean(spark):
    df = spark.createDataFrame([("s", 1, 2.0, 0.1), ("s", 2, -2.0, 0.1), ("s", 3, None, None), ("s", 4, 1.0, 0.0)], "stat string, e int, d double, s2 double")
    out = {r["e"]: r["value"] for r in shrinkage.shrink_normal(df, shrinkage.fit_normal(df, ["stat"]), ["stat"]).collect()}
    assert out[3] == 0.0 and out[4] == 0.0 and out[1] == pytest.approx(2 * 3.9 / 4.0)


def test_variance_prior_and_single_game(spark):
    rng = np.random.default_rng(0)
    sigma2 = 12 * 3.0 / rng.chisquare(12, 3000)
    df = spark.createDataFrame([("s", i, float(v * rng.chisquare(40) / 40), 41.0) for i, v in enumerate(sigma2)] + [("s", -1, 0.0, 1.0)],
                               "stat string, e int, s2 double, n double")
    prior = shrinkage.fit_scaled_inv_chi2(df, ["stat"])
    r = prior.first()
    assert r["param1"] == pytest.approx(12, rel=0.25) and r["param2"] == pytest.approx(3, rel=0.1)
    single = shrinkage.shrink_variance(df, prior, ["stat"]).where("e = -1").first()["value"]
    assert single == pytest.approx(r["param2"])


def test_relative_risk(spark):
    df = spark.createDataFrame([("s", 1, 0.0, 0.0), ("s", 2, 30.0, 10.0), ("s", 3, 5.0, 10.0)], "stat string, e int, x double, n double")
    out = {r["e"]: r["value"] for r in shrinkage.shrink_relative_risk(df, shrinkage.fit_relative_risk(df, ["stat"]), ["stat"]).collect()}
    k = 1 / (np.var([3.0, 0.5]) - 0.1)
    assert out[1] == 1.0 and out[2] == pytest.approx((30 + k) / (10 + k))


# ------------------------------------------------------------------ sources and checks
def test_missing_columns_are_named(spark):
    with pytest.raises(pl.MissingColumns, match="pt_x: missing columns \\['b'\\]"):
        pl.require_columns(spark.createDataFrame([(1,)], "a int"), "pt_x", ["a", "b"])
    with pytest.raises(pl.MissingColumns):
        pl.pick_columns(spark.createDataFrame([(1,)], "a int"), "pt_x", [("b",)], ("v",))


def test_payload_without_result_sets_is_an_error(spark):
    with pytest.raises(PySparkException):
        pl.result_set_rows(spark.createDataFrame([("{}",)], "payload string"), "payload").collect()


def test_prefer_source_per_key(spark):
    a, b = spark.createDataFrame([(1, "x")], "g int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "g int, v string")
    got = {(r["g"], r["v"], r["origin"]) for r in pl.prefer_source(a, b, ["g"]).collect()}
    assert got == {(1, "x", "primary"), (2, "z", "backup")}


def test_latest_value_per_column(spark):
    df = spark.createDataFrame([(1, 2001, 5.0, None), (1, 2003, None, 2.0), (1, 2002, 6.0, 9.0)], "e int, y int, a double, b double")
    assert tuple(sequences.latest_per_column(df, "e", ["y"], ["a", "b"]).first()) == (1, 6.0, 2.0)


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, n int, v string")
    assert {r["k"]: r["v"] for r in quality.last_wins(df, ["k"], "n").collect()} == {"a": "new", "b": "only"}


def test_micros_keep_microseconds(spark):
    got = one(spark, sc.micros(F.lit("1970-01-02 00:00:01.000002").cast("timestamp_ntz")))
    assert got == 86_400_000_000 + 1_000_002 and math.isfinite(got)


def test_asks_of_shared_names_stay_as_many_rows(spark):
    spoken = spark.createDataFrame([(1, 5, "a", "x"), (1, 5, "b", "y"), (1, 5, "b", "y"), (1, 9, "a", "z"), (1, 4, "lone", "v"), (1, 6, "none", "w"), (None, 7, "a", "u")],
                                   "k int, ord int, name string, more string")
    acts = spark.createDataFrame([(1, "a", 1, 6), (1, "a", 2, 5), (1, "b", 4, 8), (1, "b", 3, 7), (1, "lone", 8, 1), (1, "lone", None, 2)], "k int, name string, id int, ord int")
    out = sequences.resolve_names(spoken, acts.select("k", "name", "id"), ["k"], "name", "id", later=acts.select("k", "id", "ord"))
    got = sorted((r["more"], r["resolved"] or 0) for r in out.collect())
    assert got == [("u", 0), ("v", 8), ("w", 0), ("x", 1), ("y", 3), ("y", 3), ("z", 0)]
    cut = sequences.resolve_names(spoken, acts.select("k", "name", "id"), ["k"], "name", "id", later=acts.select("k", "id", "ord"), limit=2)
    assert sorted((r["more"], r["resolved"] or 0) for r in cut.collect()) == got
    # no row carries the ids of its pool, and asks are not joined back
    assert "collect_set" not in out._jdf.queryExecution().toString()


def test_only_substitutions_take_their_columns_through_the_passes(spark):
    from tallywright.operators import events
    kinds = dict.fromkeys(("ord", "period", "t", "team", "person", "value", "event_id", "assist", "blocker", "ft_n", "ft_of", "drawn", "possession"), "bigint")
    kinds |= {"made": "boolean", "distance": "double", "outs": "array<bigint>", "ins": "array<bigint>"}
    rows = [(1, "sub", 7, 11), (2, "sub", 7, 12), (3, "fga", 7, 11), (4, "sub", 7, 13), (5, "sub", 8, 21), (6, "sub", 8, None), (7, "other", None, None)]
    made = [("g", *(dict(ord=o, period=1, clock="c", kind=k, team=t, person=p, distance=2.5, outs=[p] if p else [], ins=[]).get(c) for c in events.EVENT_COLUMNS[1:]))
            for o, k, t, p in rows]
    evs = spark.createDataFrame(made, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in events.EVENT_COLUMNS))
    out = events.merge_substitutions(evs)
    got = sorted((r["ord"], r["kind"], r["person"], tuple(r["outs"])) for r in out.collect())
    assert [g[0] for g in got] == [1, 3, 4, 5, 6, 7] and got[0] == (1, "sub", 11, (11, 12)) and got[4][3] == ()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # of the other rows none


def test_steps_started_together_run_side_by_side(spark):
    import threading

    from tallywright.plans.lineage import together
    meet = threading.Barrier(3, timeout=30)

    def step(i):
        meet.wait()
        return spark.range(i).count()

    assert together(*[lambda i=i: step(i) for i in (4, 2, 7)]) == [4, 2, 7]
    assert together() == []
    with pytest.raises(ValueError, match="second"):
        together(lambda: 1, lambda: (_ for _ in ()).throw(ValueError("second")))


def test_fits_of_the_derivation_run_side_by_side(spark, monkeypatch):
    import threading

    from tallywright.plans.profile import Derivation
    names = ("differences", "stint_models", "risks", "cluster", "physicals")
    meet = threading.Barrier(len(names), timeout=30)
    d = Derivation.__new__(Derivation)
    for name in ("counts", "expected"):
        monkeypatch.setattr(Derivation, name, lambda self: None)
    for name in names:
        monkeypatch.setattr(Derivation, name, lambda self: meet.wait())
    monkeypatch.setattr(Derivation, "arithmetic", lambda self: 1 / 0)  # the run ends here
    with pytest.raises(ZeroDivisionError):
        d.run()
    assert not meet.broken


def test_the_first_row_of_a_key_moves_each_column_once(spark):
    from tallywright.operators.quality import first_per_key
    df = spark.createDataFrame([(1, 3, "c"), (1, None, "b"), (1, 2, "a"), (2, 5, "z")], "k int, o int, v string")
    out = first_per_key(df, ["k"], ["o"])
    assert sorted((r["k"], r["o"], r["v"]) for r in out.collect()) == [(1, None, "b"), (2, 5, "z")]
    assert "min_by" not in out._jdf.queryExecution().analyzed().toString()
    mapped = df.withColumn("m", F.create_map("v", "o"))
    assert {r["k"]: r["m"] for r in first_per_key(mapped, ["k"], ["o"]).collect()} == {1: {"b": None}, 2: {"z": 5}}
