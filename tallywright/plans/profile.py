"""Attributes, tendencies and traits over one assembled league.

Everything is long: ``(stat, player_id, value)``. All proportion and rate statistics are fitted in
two grouped aggregates; scores are one join of the component list with the transformed statistics.
Fields are collected with their failures; a failed fit never stops another field.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import scalars as sc
from tallywright.operators import models as md
from tallywright.operators import shrinkage as sh
from tallywright.operators.quality import unclassified_shots
from tallywright.operators.ranks import rate_scores, mid_rank, standard_score
from tallywright.operators.sequences import runs_test
from tallywright.plans import specs as sp
from tallywright.plans.lineage import cut, together

ID = "player_id"


@dataclass
class League:
    """Inputs of the derivation; see ``assemble`` for the columns."""

    roster: DataFrame
    inputs: DataFrame
    shots: DataFrame
    pbp_shots: DataFrame
    assists: DataFrame
    stints: DataFrame
    stretch_minutes: DataFrame
    contests: DataFrame
    cells: DataFrame
    combine: DataFrame
    game_logs: DataFrame
    durability: DataFrame
    team_pace: DataFrame
    fouls: DataFrame
    rebound_chances: bool = True
    extra: dict = field(default_factory=dict)


@dataclass
class Profiles:
    attributes: DataFrame
    tendencies: DataFrame
    traits: DataFrame
    priors: DataFrame
    components: DataFrame
    weights: DataFrame
    parameters: DataFrame
    notes: DataFrame
    failures: DataFrame
    population: DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------------ inputs
def chart_counts(shots: DataFrame) -> DataFrame:
    """Shot-chart counts per shooter, one pass."""
    bucket = sc.shot_bucket("action_type", "zone")
    made = F.col("made") == 1

    def n(cond):
        return F.count(F.when(cond, 1)).cast("double")

    return shots.groupBy(ID).agg(
        n(F.lit(True)).alias("CHART_FGA"), n(F.col("zone") == "Mid-Range").alias("CHART_MID_FGA"),
        n(F.col("distance") < 6).alias("CHART_RIM_FGA"), n(bucket == "DRIVING_LAYUP").alias("LAYUP_FGA"),
        n(bucket == "TOUCH").alias("TOUCH_FGA"), n((bucket == "DRIVING_DUNK") & made).alias("DRIVING_DUNK_FGM"),
        n((bucket == "STANDING_DUNK") & made).alias("STANDING_DUNK_FGM"))


def contest_columns(contests: DataFrame) -> DataFrame:
    cols = [F.sum(F.when(F.col("category") == c, F.col(k))).alias(f"{k}_{c}")
            for c in sp.CONTEST_CATEGORIES for k in ("A", "M", "E")]
    return contests.groupBy(ID).agg(*cols)


def with_load(inputs: DataFrame) -> DataFrame:
    """Box Creation and Offensive Load from box terms per 100 possessions on the floor."""
    off = F.col("OFF_POSS") / 100.0
    per = {c: sc.safe_div(F.col(c), off) for c in ("AST", "PTS", "TOV", "FGA", "FTA", "FG3A")}
    pct = F.when(F.col("FG3A") > 0, F.col("FG3M") / F.col("FG3A")).otherwise(0.0)
    made = inputs.withColumn("BOX_CREATION", sc.box_creation(per["AST"], per["PTS"], per["TOV"], per["FG3A"], pct))
    return made.withColumn("OFF_LOAD", sc.offensive_load(per["AST"], per["FGA"], per["FTA"], per["TOV"],
                                                         F.col("BOX_CREATION")))


def population_inputs(lg: League) -> tuple[DataFrame, DataFrame]:
    """(wide inputs of exposed rostered players, rostered players exposed on one side only)."""
    wide = lg.roster.select(ID).join(lg.inputs, ID, "left")
    for extra in (chart_counts(lg.shots), contest_columns(lg.contests), lg.durability):
        wide = wide.join(extra, ID, "left")
    wide = wide.na.fill(0.0)
    off, de = F.col("OFF_POSS") > 0, F.col("DEF_POSS") > 0
    return with_load(wide.where(off & de)), wide.where(off != de).select(ID)


# ------------------------------------------------------------------ proportion and rate statistics
def long_counts(wide: DataFrame, stats) -> DataFrame:
    """(stat, kind, family, player_id, x, n) for every catalogue row, from one scan."""
    rows = F.array(*[F.struct(F.lit(s.name).alias("stat"), F.lit(s.kind).alias("kind"),
                              F.lit(s.family).alias("family"), F.expr(f"cast({s.x} as double)").alias("x"),
                              F.expr(f"cast({s.n} as double)").alias("n")) for s in stats])
    return wide.select(ID, F.explode(rows).alias("s")).select("s.stat", "s.kind", "s.family", ID, "s.x", "s.n")


def shrink_counts(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(values, priors) of all proportion and rate statistics."""
    values, priors = [], []
    for family in ("beta", "gamma"):
        fit, shrink = sh.FITS[family]
        mine = long.where(F.col("family") == family)
        prior = fit(mine, ["stat"])
        values.append(shrink(mine, prior, ["stat"]).select("stat", ID, "value"))
        priors.append(prior)
    return union_all(values), union_all(priors)


def shrink_differences(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Input (stat, player_id, d, s2, free): ``free`` marks statistics with an estimated mean."""
    prior = sh.fit_normal(long, ["stat"], estimate_mean=F.col("free"))
    return sh.shrink_normal(long, prior, ["stat"]).select("stat", ID, "value"), prior


def shrink_risks(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    prior = sh.fit_relative_risk(long, ["stat"])
    return sh.shrink_relative_risk(long, prior, ["stat"]).select("stat", ID, "value"), prior


def column_of(values: DataFrame, names: dict) -> DataFrame:
    """Wide columns of some statistics: ``{column: stat}``."""
    return values.where(F.col("stat").isin(*names.values())).groupBy(ID).agg(
        *[F.max(F.when(F.col("stat") == s, F.col("value"))).alias(c) for c, s in names.items()])


# ------------------------------------------------------------------ expected values
def zone_values(shots: DataFrame) -> tuple[DataFrame, float, float]:
    """Points per attempt by zone, and of rim and other attempts."""
    s = shots.withColumn("pts", F.col("made") * F.when(F.col("shot_type").startswith("3"), 3.0).otherwise(2.0))
    rim = F.col("distance") < 6
    row = s.agg(F.avg(F.when(rim, F.col("pts"))).alias("rim"), F.avg(F.when(~rim, F.col("pts"))).alias("other")).first()
    return s.groupBy("zone").agg(F.avg("pts").alias("u")), row["rim"], row["other"]


def cell_differences(cells: DataFrame) -> DataFrame:
    """Made threes against the rate of each shot cell, per player: d and its sampling variance."""
    cell = ["general_range", "def_dist"]
    q = cells.groupBy(*cell).agg((F.sum("FG3M") / F.sum("FG3A")).alias("q"))
    a = F.col("FG3A")
    g = cells.join(q, cell).groupBy(ID).agg(
        F.sum("FG3M").alias("m"), F.sum(a).alias("a"), F.sum(a * F.col("q")).alias("e"),
        F.sum(a * F.col("q") * (1 - F.col("q"))).alias("v"))
    return g.select(ID, sc.safe_div(F.col("m") - F.col("e"), "a").alias("d"),
                    sc.safe_div("v", F.col("a") * F.col("a")).alias("s2"))


def contest_differences(wide: DataFrame) -> DataFrame:
    """Points saved per attempt in each contest category."""
    rows = []
    for cat, pts in (("P3", 3.0), ("P2", 2.0), ("R", 2.0)):
        a, m, e = (F.col(f"{k}_{cat}") for k in ("A", "M", "E"))
        q = sc.safe_div(e, a)
        rows.append(F.struct(F.lit(f"delta_{cat}").alias("stat"), sc.safe_div(pts * (e - m), a).alias("d"),
                             sc.safe_div(pts * pts * q * (1 - q), a).alias("s2")))
    return wide.select(ID, F.explode(F.array(*rows)).alias("s")).select("s.stat", ID, "s.d", "s.s2")


def contest_shares(wide: DataFrame) -> DataFrame:
    return wide.select(ID, sc.safe_div(F.col("A_P3") + F.col("A_P2"), F.col("A_Overall")).alias("perimeter"),
                       sc.safe_div(F.col("A_R"), F.col("A_Overall")).alias("rim"))


def clutch_differences(wide: DataFrame, game_logs: DataFrame) -> tuple[DataFrame, dict]:
    tsa = sc.shooting_attempts("FGA", "FTA")
    mu = game_logs.agg((F.sum("PTS") / F.sum(tsa)).alias("mu")).first()["mu"]
    sigma2 = game_logs.agg((F.sum(F.pow(F.col("PTS") - mu * tsa, F.lit(2))) / F.sum(tsa)).alias("s")).first()["s"]
    late = sc.shooting_attempts("CLUTCH_FGA", "CLUTCH_FTA")
    rest = tsa - late
    d = sc.safe_div("CLUTCH_PTS", late) - sc.safe_div(F.col("PTS") - F.col("CLUTCH_PTS"), rest)
    ok = (late > 0) & (rest > 0)
    return wide.select(ID, F.when(ok, d).alias("d"),
                       F.when(ok, sigma2 * (sc.safe_div(F.lit(1.0), late) + sc.safe_div(F.lit(1.0), rest))).alias("s2")), {"mu": mu, "sigma2": sigma2}


def stretch_differences(stretch_minutes: DataFrame) -> DataFrame:
    """Mean continuous stretch per player, sampling variance from the pooled within-player variance."""
    g = stretch_minutes.groupBy(ID).agg(F.avg("minutes").alias("d"), F.coalesce(F.var_samp("minutes"), F.lit(0.0)).alias(
        "v"), F.count(F.lit(1)).alias("n"))
    pooled = g.agg((F.sum((F.col("n") - 1) * F.col("v")) / F.sum(F.col("n") - 1)).alias("p")).first()["p"]
    return g.select(ID, "d", (F.lit(pooled) / F.col("n")).alias("s2"))


def stint_targets(lg: League, zones: DataFrame) -> tuple[DataFrame, float]:
    """Stints with zone value and rim attempts of their shots summed from the shot chart."""
    chart = lg.shots.join(zones, "zone").select("game_id", "event_id", "u",
                                                F.when(F.col("distance") < 6, 1.0).otherwise(0.0).alias("rim1"))
    keys, lineups = ["game_id", "period", "span_from", "offense_team"], ["offense", "defense"]
    stints = cut(lg.stints)
    # the ten players of a stint do not move with it: few lineups meet, each pair has a number while stints are joined
    pairs = cut(stints.select(*lineups).distinct().withColumn("__pair", F.monotonically_increasing_id()))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}")) for c in lineups]
    numbered = stints.alias("s").join(pairs.alias("l"), same, "left").select(*[F.col(f"s.{c}") for c in stints.columns if c not in lineups], "__pair")
    fired = stints.select(*keys, F.explode("shot_ids").alias("event_id"))
    per = cut(fired.join(chart, ["game_id", "event_id"], "left").groupBy(*keys).agg(
        F.sum("u").alias("sq"), F.sum("rim1").alias("rim"), F.count("u").alias("hit"), F.count(F.lit(1)).alias("all")))
    share = per.agg(sc.safe_div(F.sum("hit"), F.sum("all"))).first()[0]
    out = numbered.drop("shot_ids").join(per.select(*keys, "sq", "rim"), keys, "left").na.fill(0.0, ["sq", "rim"])
    out = out.join(pairs, "__pair").drop("__pair")
    return out.withColumnRenamed("poss", "w"), 1.0 if share is None else share


# ------------------------------------------------------------------ the derivation
class Derivation:
    """``models=False`` leaves out every iterative fit; the fields that need one count as failed."""

    def __init__(self, lg: League, models: bool = True):
        self.lg, self.models = lg, models
        self.spark: SparkSession = lg.roster.sparkSession
        self.wide, self.one_sided = population_inputs(lg)
        self.wide = cut(self.wide)
        self.values, self.priors, self.failed, self.parameters, self.notes = [], [], {}, [], []
        self.kinds = {s.name: s.kind for s in sp.ALL_SHRUNK}
        self.stat_errors = {}
        self.zones = self.clusters = None

    # -------------------------------------------------------------- bookkeeping
    def attempt(self, names, fn):
        """Run one model; on a model error every statistic it owes is marked as failed."""
        if not self.models:
            for n in names:
                self.stat_errors[n] = "model fits left out"
            return None
        try:
            return fn()
        except (md.ModelError, ValueError) as e:
            for n in names:
                self.stat_errors[n] = f"{type(e).__name__}: {e}"
            return None

    def log(self, model, **values):
        self.parameters += [(model, k, None if v is None else float(v)) for k, v in values.items()]

    def take(self, pair, kind="attribute"):
        values, priors = pair
        self.values.append(values)
        self.priors.append(priors.withColumn("kind", F.lit(kind)))

    # -------------------------------------------------------------- stages
    def counts(self):
        self.long = long_counts(self.wide, sp.ALL_SHRUNK)
        values, priors = shrink_counts(self.long)
        self.base = cut(values)
        self.values.append(self.base)
        kinds = F.create_map(*[F.lit(v) for s in sp.ALL_SHRUNK for v in (s.name, s.kind)])
        self.base_priors = cut(priors.withColumn("kind", F.element_at(kinds, F.col("stat"))))
        self.priors.append(self.base_priors)
        for r in self.base_priors.where(F.col("error").isNotNull()).collect():
            guard = sh.proportion_offenders if r["family"] == "beta" else sh.count_offenders
            shown = guard(self.long.where(F.col("stat") == r["stat"])).limit(15).collect()
            who = ", ".join(f"{o[ID]} ({o['x']:g} of {o['n']:g})" for o in shown)
            self.stat_errors[r["stat"]] = r["error"] + (f": {who}" if who else "")

    def shot_models(self) -> list:
        """Steps that each fit one model of shots and return its differences (none, if it failed)."""
        lg, steps = self.lg, []
        bucket = sc.shot_bucket("action_type", "zone")
        unclear = unclassified_shots(lg.shots, "action_type", "zone").limit(20).collect()
        for name, cond in (("E1 DRIVING_LAYUP d", bucket == "DRIVING_LAYUP"), ("E1 TOUCH d", bucket == "TOUCH"),
                           ("E1 Mid-Range d", F.col("zone") == "Mid-Range")):
            if unclear and name != "E1 Mid-Range d":
                self.stat_errors[name] = "close shots no family claims: " + "; ".join(
                    f"{r['action_type']} ({r['n']})" for r in unclear)
                continue
            steps.append(lambda s=lg.shots.where(cond), n=name: self.shot_differences(s, n))
        return steps

    def shot_differences(self, shots, name):
        model = self.attempt([name], lambda: md.fit_shot_model(shots, ["action_type", "area"], name=name))
        if model is None:
            return None
        self.log(name, **{"lambda": model.penalty, "n_shots": model.n})
        scored = shots.withColumn("p", model.probability()).withColumn("stat", F.lit(name))
        return sh.observed_minus_expected(scored, ["stat", ID], "made", "p").select("stat", ID, "d", "s2")

    def expected(self):
        """Values of the zones, which the differences and the stints both read."""
        zones, self.u_rim, self.u_other = zone_values(self.lg.shots)
        self.zones = cut(zones)
        for r in self.zones.collect():
            self.log("E4", **{f"u[{r['zone']}]": r["u"]})
        self.log("E4", u_rim=self.u_rim, u_other=self.u_other)

    def differences(self):
        lg = self.lg
        if self.zones is None:
            self.expected()
        *scored, slopes = together(*self.shot_models(), lambda: self.attempt(["Stamina beta"], self.stamina_slopes))
        parts = [s for s in scored if s is not None]
        parts.append(cell_differences(lg.cells).withColumn("stat", F.lit("E2 3P d")))
        valued = lg.shots.join(self.zones, "zone")
        own = valued.select(ID, "u", F.lit("shot-choice value d").alias("stat"))
        helped = lg.assists.join(valued.select("game_id", "event_id", "u"), ["game_id", "event_id"]).select(
            F.col("assister").alias(ID), "u", F.lit("assisted-shot quality d").alias("stat"))
        parts.append(sh.mean_difference(own.unionByName(helped), ["stat"], [ID], "u").drop("n"))
        parts.append(contest_differences(self.wide))
        fixed = union_all([p.select("stat", ID, "d", "s2", F.lit(False).alias("free")) for p in parts])
        free = []
        if slopes is not None:
            free.append(slopes.withColumn("stat", F.lit("Stamina beta")))
        free.append(stretch_differences(lg.stretch_minutes).withColumn("stat", F.lit("stint length")))
        late, logged = clutch_differences(self.wide, lg.game_logs)
        self.log("Clutch", **{"league PPTSA mu": logged["mu"], "per-attempt variance sigma^2": logged["sigma2"]})
        free.append(late.withColumn("stat", F.lit("clutch PPTSA delta")))
        # cut, as the names and the values are both read from it
        rows = cut(fixed.unionByName(union_all([f.select("stat", ID, "d", "s2", F.lit(True).alias("free")) for f in free])))
        # everyone of the population has a row per statistic; no attempts means no difference
        names = [r[0] for r in rows.select("stat").distinct().collect()]
        grid = self.wide.select(ID, F.explode(F.array(*[F.lit(n) for n in names])).alias("stat"))
        marks = {n: n in ("Stamina beta", "stint length", "clutch PPTSA delta") for n in names}
        free_map = F.create_map(*[F.lit(v) for n in names for v in (n, marks[n])])
        full = grid.join(rows.drop("free"), ["stat", ID], "left").withColumn("free", F.element_at(free_map, F.col("stat")))
        full = cut(full)
        values, priors = shrink_differences(full)
        trait = F.when(F.col("stat") == "clutch PPTSA delta", "trait").otherwise("attribute")
        self.values.append(values)
        self.normal_priors = cut(priors.withColumn("kind", trait))
        self.priors.append(self.normal_priors)
        self.tau2 = {}
        for r in self.normal_priors.collect():
            self.tau2[r["stat"]] = r["param1"]
            if r["error"]:
                self.stat_errors[r["stat"]] = r["error"]
            elif r["param1"] == 0:
                self.notes.append((r["stat"], "spread is all noise: every value equals the mean of the prior"))

    def stamina_slopes(self):
        lg = self.lg
        model = md.fit_shot_model(lg.shots, ["action_type", "area", "shot_type"], name="E1-all")
        self.log("E1-all", **{"lambda": model.penalty})
        p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), model.probability()))
        chart = lg.shots.select("game_id", "event_id", ID, "made", F.log(p / (1 - p)).alias("offset"))
        timed = lg.pbp_shots.where(F.col("minutes_on").isNotNull()).select("game_id", "event_id", "minutes_on")
        j = timed.join(chart, ["game_id", "event_id"]).join(self.wide.select(ID), ID, "left_semi")
        slopes = md.entity_slopes(j, ID, "made", "minutes_on", "offset")
        return slopes.select(ID, F.col("slope").alias("d"), (F.col("se") * F.col("se")).alias("s2"))

    def risks(self):
        load = column_of(self.base, {"ol": "Offensive Load per100", "creation": "creation possessions per100"})
        w = self.wide.join(load, ID, "left").withColumn("ln_ol", F.log("ol")).withColumn(
            "pass_risk", sc.safe_div("POTENTIAL_AST", "PASSES_MADE"))
        rows, fits = [], []
        for name, count, exposure, cov in (
                ("E3 handling turnovers", "tov_handling", "DRIBBLES", ["ln_ol", "creation"]),
                ("E3 bad-pass turnovers", "tov_bad_pass", "PASSES_MADE", ["pass_risk"]),
                ("E3 decision turnovers", "tov_decision", "OFF_POSS", ["ln_ol"])):
            needs = {"ln_ol": "Offensive Load per100", "creation": "creation possessions per100"}
            missing = [needs[c] for c in cov if c in needs and needs[c] in self.stat_errors]
            if missing:
                self.stat_errors[name] = f"needs {missing[0]}: {self.stat_errors[missing[0]]}"
                continue
            fits.append((name, count, exposure, lambda c=count, e=exposure, v=cov, n=name: self.attempt([n], lambda: md.fit_poisson(w, c, e, v, n))))
        for (name, count, exposure, _fit), fit in zip(fits, together(*[f[-1] for f in fits])):
            if fit is None:
                continue
            self.log(name, intercept=fit["intercept"], **fit["slopes"])
            rows.append(w.select(F.lit(name).alias("stat"), ID, F.col(count).alias("x"),
                                 md.poisson_expected(fit, exposure).alias("n")))
        # blocks against the rate per contest category
        attempts = self.lg.contests.groupBy("category").agg(F.sum("A").alias("a")).collect()
        league = {r["category"]: r["a"] for r in attempts}
        blocks = self.lg.inputs.agg(*[F.sum(f"pbp_blocks_{c}").alias(c) for c in ("R", "P2", "P3")]).first()
        short = [c for c in ("R", "P2", "P3") if not league.get(c) or league[c] <= 0]
        if short:
            self.stat_errors["RR_BLK"] = f"no attempts in contest category {short[0]}"
        else:
            rate = {c: blocks[c] / league[c] for c in ("R", "P2", "P3")}
            self.log("E5", **{f"b[{c}]": v for c, v in rate.items()})
            expected = sum((F.col(f"A_{c}") * F.lit(v) for c, v in rate.items()), F.lit(0.0))
            rows.append(self.wide.select(F.lit("RR_BLK").alias("stat"), ID, F.col("pbp_blocks").alias("x"),
                                         expected.alias("n")))
        self.take(shrink_risks(cut(union_all(rows))))

    def stint_models(self):
        rows, share = stint_targets(self.lg, self.zones)
        self.log("stint ridge", **{"stint FGA matched to shot chart": share})
        owed = ["RAPM offense", "RAPM defense", "shot-quality defense", "rim defense"]
        # the fit reads its rows several times
        fits = self.attempt(owed, lambda: md.fit_stint_ridges(
            cut(rows.select("game_id", "offense", "defense", "w", "pts", "sq", "rim")), ["pts", "sq", "rim"], entity=ID))
        if fits is None:
            return
        for target, name in (("pts", "RAPM (points)"), ("sq", "shot-quality ridge"), ("rim", "rim-attempts ridge")):
            self.log(name, **{"lambda": fits[target].penalty, "intercept": fits[target].intercept,
                              "stint rows": fits[target].rows})
        for target, side, stat in (("pts", "offense", "RAPM offense"), ("pts", "defense", "RAPM defense"),
                                   ("sq", "defense", "shot-quality defense"), ("rim", "defense", "rim defense")):
            self.values.append(fits[target].coefficients.join(self.wide.select(ID), ID, "left_semi").select(
                F.lit(stat).alias("stat"), ID, F.col(side).alias("value")).where(F.col("value").isNotNull()))

    def arithmetic(self):
        """Scores that are plain arithmetic on shrunk statistics."""
        known = cut(union_all([v.select("stat", ID, "value") for v in self.values]))
        self.values = [known]
        names = {"phi": "FOUL%", "rate_all": "D_FGA Overall per100", "rate_p3": "D_FGA P3 per100", "rate_p2": "D_FGA P2 per100",
                 "rate_r": "D_FGA R per100", "d3": "delta_P3", "d2": "delta_P2", "dr": "delta_R",
                 "ppp": "defensive Postup PPP", "post": "defensive Postup possessions per100", "gamma": "rim defense",
                 "contested": "contested shots per100"}
        w = self.wide.join(column_of(known, names), ID, "left").join(contest_shares(self.wide), ID, "left")
        foul = self.lg.fouls.first()
        phi_bar = known.where(F.col("stat") == "FOUL%").agg(F.avg("value")).first()[0]
        out = {}
        derived = ("perimeter foul cost", "rim foul cost", "net perimeter points saved", "net rim points saved")
        if not foul or foul["shooting_fouls"] <= 0:
            for n in derived:
                self.stat_errors[n] = "no shooting fouls in the event log"
            cost = F.lit(None).cast("double")
        else:
            f_bar = foul["shooting_foul_ft_points"] / foul["shooting_fouls"]
            self.log("foul cost", f_bar=f_bar, phi_bar=phi_bar)
            cost = F.lit(f_bar) * (F.col("phi") - F.lit(phi_bar)) * F.col("rate_all")
            idle = w.where(F.col("A_Overall") <= 0).select(ID).limit(20).collect()
            if idle:
                for n in derived:
                    self.stat_errors[n] = f"no contests for players with exposure: {[r[0] for r in idle]}"
        out["perimeter foul cost"] = cost * F.col("perimeter")
        out["rim foul cost"] = cost * F.col("rim")
        out["net perimeter points saved"] = (F.col("rate_p3") * F.col("d3") + F.col("rate_p2") * F.col("d2")
                                             - cost * F.col("perimeter"))
        out["rim contest"] = F.col("rate_r") * F.col("dr")
        out["rim deterrence"] = -F.col("gamma") * F.lit(self.u_rim - self.u_other)
        out["net rim points saved"] = F.col("rate_r") * F.col("dr") + out["rim deterrence"] - cost * F.col("rim")
        league = self.lg.inputs.agg(F.sum("SYN_D_Postup_PTS").alias("p"), F.sum("SYN_D_Postup_POSS").alias("n")).first()
        if league["n"]:
            self.log("post defense", **{"league PPP": league["p"] / league["n"]})
            out["post points saved"] = F.col("post") * (F.lit(league["p"] / league["n"]) - F.col("ppp"))
        out["Box Creation per100"] = F.col("BOX_CREATION")
        rows = F.array(*[F.struct(F.lit(k).alias("stat"), v.cast("double").alias("value")) for k, v in out.items()])
        self.values.append(w.select(ID, F.explode(rows).alias("s")).select("s.stat", ID, "s.value"))
        if "contested shots per100" not in self.stat_errors and "D_FGA Overall per100" not in self.stat_errors:
            helped = md.ols_residual(w, "contested", [F.col("rate_all")])
            self.values.append(helped.select(F.lit("help contests residual").alias("stat"), ID,
                                             F.col("residual").alias("value")))

    def physicals(self):
        lg = self.lg
        feats = ["height_in", "weight_lb", "wingspan_in", "age"]
        r = lg.roster.join(lg.combine.select(ID, *sp.COMBINE_TESTS), ID, "left")
        r = cut(r)
        pop = self.wide.select(ID)
        broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in feats])
        lacking = [x[0] for x in r.where(broken).select(ID).limit(20).collect()]
        design = [F.col(c).cast("double") for c in feats] + md.one_hot(r, "position")
        if lacking:
            self.stat_errors |= {t: f"missing height, weight, wingspan or age for {lacking}" for t in sp.COMBINE_TESTS}
        tests = [] if lacking else sp.COMBINE_TESTS
        fits = together(*[lambda t=t: self.attempt([t], lambda: md.fit_ridge(r, design, t, ["roster_order", ID], t)) for t in tests])
        for t, fit in zip(tests, fits):
            if fit is None:
                continue
            self.log(f"{t} imputation", **{"lambda": fit.penalty, "n_fit": fit.n})
            self.values.append(r.join(pop, ID, "left_semi").select(
                F.lit(t).alias("stat"), ID, F.coalesce(F.col(t), fit.predict(design)).alias("value")))
        who = r.select(ID, "team_id", "position", F.col("age").cast("double").alias("age"),
                       F.col("height_in").cast("double").alias("height_in"), F.col("weight_lb").cast("double").alias(
                           "weight_lb")).join(lg.team_pace, "team_id", "left")
        stars = column_of(self.base, {"drives": "DRIVES per100", "above": "above-rim makes per100"})
        w = cut(self.wide.select(ID, "AVG_SPEED_OFF", "AVG_SPEED_DEF", (48.0 * sc.safe_div(
            F.col("DIST_MILES_OFF") + F.col("DIST_MILES_DEF"), "SPEED_MIN")).alias("dist48")).join(who, ID).join(stars, ID, "left"))
        labels = md.one_hot(w, "position")
        motion = [*labels, F.col("age"), F.col("pace")]
        outcomes = ("AVG_SPEED_OFF", "AVG_SPEED_DEF", "drives", "dist48", "above")
        lacks = w.agg(F.max(F.col("age").isNull() | F.col("pace").isNull()).alias("motion"),
                      *[F.max(F.col(c).isNull() | F.isnan(c)).alias(c) for c in outcomes]).first()
        fits = []
        for col, stat, cols in (("AVG_SPEED_OFF", "AVG_SPEED_OFF residual", motion),
                                ("AVG_SPEED_DEF", "AVG_SPEED_DEF residual", motion),
                                ("drives", "DRIVES per100 residual", motion),
                                ("dist48", "distance per 48 residual", motion),
                                ("above", "above-rim residual", [F.col("height_in"), *labels])):
            if (lacks["motion"] and cols is motion) or lacks[col]:
                self.stat_errors[stat] = "undefined for players with exposure"
                continue
            fits.append((stat, lambda s=stat, c=col, d=cols: self.attempt([s], lambda: md.ols_residual(w, c, d))))
        for (stat, _fit), res in zip(fits, together(*[fit for _stat, fit in fits])):
            if res is not None:
                self.values.append(res.select(F.lit(stat).alias("stat"), ID, F.col("residual").alias("value")))
        self.values.append(w.select(F.lit("WEIGHT").alias("stat"), ID, F.col("weight_lb").alias("value")))

    # -------------------------------------------------------------- scores
    def transformed(self) -> DataFrame:
        """(stat, player_id, value, Z, z) of every statistic used by a score."""
        used = {p.stat for p in sp.COMPONENTS} | {s for _t, _g, parts in sp.BLENDS.values() for _n, s, _x in parts} | {
            s for _n, s, _t in sp.STAMINA} | {"clutch PPTSA delta", "durability: games missed / roster games"}
        values = union_all([v.select("stat", ID, "value") for v in self.values])
        self.all_values = cut(values)
        known = self.all_values.where(F.col("stat").isin(*used) & F.col("value").isNotNull() & ~F.isnan("value"))
        # ranked without the last rounding noise: what is equal by construction ties
        keyed = known.withColumn("__key", F.round("value", 12))
        ranked = mid_rank(keyed, ["stat"], "__key", "__pct").withColumn("Z", sc.probit("__pct")).drop("__pct", "__key")
        return cut(standard_score(ranked, ["stat"], "value", "z_std"))

    def fields(self) -> list:
        """Component list with fitted blends and the conditional stamina parts."""
        parts = []
        for p in sp.COMPONENTS:
            if not self.lg.rebound_chances and p.field in sp.REBOUND_FALLBACK:
                continue
            parts.append(p)
        if not self.lg.rebound_chances:
            for f, stat in sp.REBOUND_FALLBACK.items():
                parts.append(sp.Part(f, stat + "*", stat))
                self.notes.append((f, f"rates on {stat} only, as the chances are not in the data"))
        kept = []
        for name, stat, how in sp.STAMINA:
            if stat in self.tau2 and self.tau2[stat] == 0:
                self.notes.append(("stamina", f"{name} is left out: it does not vary"))
            else:
                kept.append((name, stat, how))
        parts += [sp.Part("stamina", n, s, 1.0 / len(kept), how) for n, s, how in kept]
        return parts

    def blends(self) -> list:
        parts, self.weights, fits = [], [], []
        for f, (target, orientation, comps) in sp.BLENDS.items():
            missing = [s for s in (target, *[c[1] for c in comps]) if s in self.stat_errors]
            if missing:
                self.stat_errors[f"field:{f}"] = f"needs {missing[0]}: {self.stat_errors[missing[0]]}"
                continue
            cols = {f"c{i}": s for i, (_n, s, _g) in enumerate(comps)}
            wide = self.scored.where(F.col("stat").isin(*cols.values())).groupBy(ID).agg(
                *[F.max(F.when(F.col("stat") == s, F.lit(g) * F.col("Z"))).alias(c)
                  for c, (_n, s, g) in zip(cols, comps)])
            aim = self.all_values.where(F.col("stat") == target).select(ID, (F.lit(orientation) * F.col("value")).alias("t"))
            joined = wide.join(aim, ID, "left")
            fits.append((f, cols, comps, lambda f=f, j=joined, c=cols: self.attempt([f"field:{f}"], lambda: self.blend(j, c))))
        for (f, cols, comps, _fit), weights in zip(fits, together(*[x[-1] for x in fits])):
            if weights is None:
                continue
            for c, (name, stat, sign) in zip(cols, comps):
                self.weights.append((f, name, float(weights[c])))
                parts.append(sp.Part(f, name, stat, float(weights[c]), "Z", sign))
                if weights[c] == 0:
                    self.notes.append((f, f"'{name}' is left out: its blend weight is zero"))
        return parts

    @staticmethod
    def blend(joined, cols):
        joined = joined.persist()
        try:
            return md.blend_weights(joined, list(cols), "t")
        finally:
            joined.unpersist()

    def run(self) -> Profiles:
        together(self.counts, self.expected)
        # none of these reads what another makes
        together(self.differences, self.stint_models, self.risks, self.cluster, self.physicals)
        self.arithmetic()
        self.scored = self.transformed()
        parts = self.fields() + self.blends()
        comp = self.spark.createDataFrame(
            [(i, p.field, p.component, p.stat, float(p.weight), p.transform, float(p.sign)) for i, p in enumerate(parts)],
            "position int, field string, component string, stat string, weight double, how string, sign double")
        # the component list is this catalogue, so its size is fixed
        joined = self.scored.join(F.broadcast(comp), "stat")
        moved = F.col("sign") * F.when(F.col("how") == "Z", F.col("Z")).when(
            F.col("how") == "z", F.col("z_std")).when(F.col("how") == "raw", F.col("value"))
        rows = cut(joined.select(
            ID, "field", "component", "position", (F.col("sign") * F.col("value")).alias("value"),
            F.when(F.col("how").isin("Z", "z"), moved).alias("z"), (F.col("weight") * moved).alias("share"),
            (F.col("weight") != 0).cast("int").alias("counts")))
        need = {}
        for p in parts:
            if p.weight != 0:
                need[p.field] = need.get(p.field, 0) + 1
        # added in catalogue order, so equal parts give equal scores on every run
        ordered = F.array_sort(F.collect_list(F.struct("position", "share")))
        total = rows.where("counts = 1").groupBy("field", ID).agg(
            F.aggregate(ordered, F.lit(0.0), lambda acc, x: acc + x["share"]).alias("score"),
            F.count("share").alias("n_parts"))
        wanted = F.create_map(*[F.lit(v) for f, n in need.items() for v in (f, n)])
        complete = cut(total.where(F.col("n_parts") == F.element_at(wanted, F.col("field"))))
        return self.finish(parts, rows, complete)

    # -------------------------------------------------------------- outputs
    def finish(self, parts, rows, complete) -> Profiles:
        size = self.wide.count()
        have = {r["field"]: r["n"] for r in complete.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
        failures = []
        for a in sp.ATTRIBUTES:
            if have.get(a, 0) == size and size:
                continue
            causes = [self.stat_errors[p.stat] for p in parts if p.field == a and p.stat in self.stat_errors]
            causes += [self.stat_errors[k] for k in (f"field:{a}",) if k in self.stat_errors]
            message = causes[0] if causes else f"score undefined for {size - have.get(a, 0)} players"
            failures.append(("attribute", a, "abort" if message.startswith("guard") else "failed", message))
        ok = [a for a in sp.ATTRIBUTES if a not in {f[1] for f in failures}]
        rated = rate_scores(complete.where(F.col("field").isin(*ok)), ["field"], "score").select(
            ID, F.col("field").alias("attribute"), "score", "percentile", "rating", F.lit(0).alias("placeholder"))
        everyone = self.lg.roster.select(ID)
        absent = everyone.join(self.wide.select(ID), ID, "left_anti")

        def fill(names, **cols):
            each = F.explode(F.array(*[F.lit(n) for n in names]).cast("array<string>"))
            return absent.select(ID, each.alias("name"), *[v.alias(k) for k, v in cols.items()])

        null = F.lit(None).cast("double")
        attributes = rated.unionByName(fill(ok, score=null, percentile=null, rating=F.lit(sp.PLACEHOLDER_RATING),
                                            placeholder=F.lit(1)).withColumnRenamed("name", "attribute"))
        # tendencies
        t_bad = [t.name for t in sp.TENDENCIES if t.name in self.stat_errors]
        failures += [("tendency", t, "abort" if self.stat_errors[t].startswith("guard") else "failed",
                      self.stat_errors[t]) for t in t_bad]
        t_ok = [t.name for t in sp.TENDENCIES if t.name not in t_bad]
        counts = self.long.where(F.col("kind") == "tendency")
        tend = counts.join(self.base, ["stat", ID]).where(F.col("stat").isin(*t_ok)).select(
            ID, F.col("stat").alias("tendency"), F.col("x").alias("numerator"), F.col("n").alias("denominator"),
            sc.safe_div("x", "n").alias("raw_rate"), "value")
        means = self.base_priors.where(F.col("stat").isin(*t_ok)).select(F.col("stat").alias("tendency"), F.col("mean").alias("value"))
        tend = tend.unionByName(fill(t_ok).withColumnRenamed("name", "tendency").join(means, "tendency").select(
            ID, "tendency", null.alias("numerator"), null.alias("denominator"), null.alias("raw_rate"), "value"))
        traits, extra_rows, t_fail, extra_priors = self.traits(complete)
        failures += t_fail
        one_sided = [r[0] for r in self.one_sided.limit(20).collect()]
        if one_sided:
            failures.append(("population", "exposure", "failed", f"exposure on one side only: {one_sided}"))
        z0 = fill([t for t in sp.TRAITS if t not in {f[1] for f in t_fail}], value=null, z_score=F.lit(0.0))
        traits = traits.unionByName(z0.withColumnRenamed("name", "trait"))
        traits = traits.withColumn("tier", sc.tier("z_score")).withColumn("tier_name", sc.tier_name("trait", "tier"))
        comps = union_all([rows.select(ID, "field", "component", "value", "z"), *extra_rows])
        priors = union_all([p.select("kind", F.col("stat").alias("name"), *[c for c in (
            "family", "param1", "param2", "mean", "n_entities")]) for p in
            [x.where(F.col("error").isNull()) for x in self.priors] + extra_priors])
        mk = self.spark.createDataFrame
        return Profiles(
            attributes=cut(attributes), tendencies=cut(tend), traits=cut(traits), priors=priors, components=comps,
            weights=mk(self.weights, "field string, component string, weight double"),
            parameters=mk(list({(m, k): (m, k, v) for m, k, v in self.parameters}.values()),
                          "model string, key string, value double"),
            notes=mk(self.notes, "field string, note string"),
            failures=mk(failures, "kind string, name string, status string, message string"), population=self.wide.select(ID))

    def traits(self, complete):
        out, rows, failed, priors = [], [], [], []

        def add(name, df):
            out.append(df.select(ID, F.lit(name).alias("trait"), "value", "z_score"))

        def audit(name, component, df, value, z):
            rows.append(df.select(ID, F.lit(f"trait:{name}").alias("field"), F.lit(component).alias("component"),
                                  value.cast("double").alias("value"), z.cast("double").alias("z")))

        def fail(name, stat):
            message = self.stat_errors[stat]
            failed.append(("trait", name, "abort" if message.startswith("guard") else "failed", message))

        missed = "durability: games missed / roster games"
        for name, stat, sign in (("durability", missed, -1.0), ("clutch", "clutch PPTSA delta", 1.0)):
            if stat in self.stat_errors:
                fail(name, stat)
                continue
            df = self.scored.where(F.col("stat") == stat).select(ID, "value", (F.lit(sign) * F.col("z_std")).alias("z_score"))
            add(name, df)
            audit(name, "games missed rate*" if name == "durability" else "PPTSA delta*", df, F.col("value"),
                  F.col("z_score") if name == "clutch" else F.lit(None))
        hustle = complete.where(F.col("field") == "trait:hustle").select(F.lit("h").alias("g"), ID, F.col("score").alias("value"))
        bad = [p.stat for p in sp.COMPONENTS if p.field == "trait:hustle" and p.stat in self.stat_errors]
        if bad:
            fail("hustle", bad[0])
        else:
            add("hustle", standard_score(hustle, ["g"], "value", "z_score"))
        runs = runs_test(self.lg.shots.withColumn(
            "clock_down", -(F.col("minutes_remaining") * 60 + F.col("seconds_remaining"))), ID,
            ["game_date", "game_id", "period", "clock_down", "event_id"], F.col("made") == 1)
        streak = self.wide.select(ID).join(runs.select(ID, (-F.col("z_runs")).alias("value")), ID, "left").select(
            ID, (F.coalesce("value", F.lit(0.0)) + 0.0).alias("value"))
        streak = cut(streak.withColumn("z_score", F.col("value")))  # read by the trait and by the audit
        add("streaky", streak)
        audit("streaky", "-z_runs", streak, F.col("value"), F.col("value"))
        needs = [s for s in sp.CLUSTER_FEATURES if s in self.stat_errors]
        if needs:
            fail("consistency", needs[0])
        else:
            if self.clusters is None:
                fail("consistency", "consistency")
            else:
                df, prior = self.clusters
                add("consistency", df)
                audit("consistency", "cluster", df, F.col("cluster"), F.lit(None))
                audit("consistency", "-ln s*^2", df, F.col("value"), F.col("z_score"))
                priors.append(prior.select(F.lit("trait").alias("kind"), F.concat(
                    F.lit("consistency cluster "), F.col("cluster").cast("string")).alias("stat"), "family", "param1",
                    "param2", "mean", "n_entities"))
        return union_all(out), rows, failed, priors

    def cluster(self):
        """Its features are counts, so it does not wait for the other models."""
        if not any(s in self.stat_errors for s in sp.CLUSTER_FEATURES):
            self.clusters = self.attempt(["consistency"], self.consistency)

    def consistency(self):
        stats = [s for s in sp.CLUSTER_FEATURES if s not in ("height", "position index")]
        cols = {f"f{i}": s for i, s in enumerate(stats)}
        body = self.lg.roster.select(ID, F.col("height_in").cast("double").alias("height"),
                                     F.col("position_index").cast("double").alias("spot"))
        feats = cut(self.wide.select(ID).join(body, ID, "left").join(column_of(self.base, cols), ID, "left"))
        names = ["height", "spot", *cols]
        if feats.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])).limit(1).count():
            raise md.ModelError("clustering needs every feature of every player")
        clustered, picked = md.best_mixture(feats, names)
        self.log("Consistency GMM", **{"k (lowest BIC)": picked["k"], **{f"BIC[k={k}]": v for k, v in picked["bic"].items()}})
        score = sc.game_score_per_minute({c: F.col(c) for c in (
            "PTS", "FGM", "FGA", "FTA", "FTM", "OREB", "DREB", "STL", "AST", "BLK", "PF", "TOV", "MIN")})
        spread = self.lg.game_logs.where(F.col("MIN") >= 10).groupBy(ID).agg(
            F.coalesce(F.var_samp(score), F.lit(0.0)).alias("s2"), F.count(F.lit(1)).alias("n"))
        g = cut(clustered.select(ID, "cluster").join(spread, ID, "left").na.fill(0, ["s2", "n"]))
        prior = sh.fit_scaled_inv_chi2(g, ["cluster"])
        broken = prior.where(F.col("error").isNotNull()).limit(1).collect()
        if broken:
            raise md.ModelError(f"consistency cluster {broken[0]['cluster']}: {broken[0]['error']}")
        own = sh.shrink_variance(g, prior, ["cluster"]).withColumn("value", -F.log("value"))
        return standard_score(own, ["cluster"], "value", "z_score"), prior


def derive_profiles(lg: League) -> Profiles:
    return Derivation(lg).run()

