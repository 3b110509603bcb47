"""When a consultation may end: budgets, emergencies, the three-zone gate, disclosure, branching, curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import beliefs
from ..plans.parameters import DEFAULTS, Parameters
from .ranks import hash_number, quantiles
from .rewards import TRAJECTORY


def turn_budget(real_turns: Column, p: Parameters = DEFAULTS) -> Column:
    return F.greatest(F.lit(p.budget_least), F.least(F.lit(p.budget_most), real_turns + p.budget_more))


def with_emergency(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """rows with u_masked (a hit turns a conclusion into a referral), late (turns after the first hit), penalty on late turns, and normalised: whether
    the turn takes part in group statistics."""
    w = Window.partitionBy(*TRAJECTORY)
    hit = F.min(F.when(F.col("emergency_hit"), F.col("t"))).over(w)
    rows = rows.withColumn("u_masked", F.when(F.col("emergency_hit") & (F.col("u") == "DIG"), "REFER").otherwise(F.col("u")))
    late = F.coalesce(F.col("t") > hit, F.lit(False))
    rows = rows.withColumn("late", late).withColumn("penalty", F.when(late, F.lit(-p.delay_penalty)).otherwise(0.0))
    return rows.withColumn("normalised", F.coalesce(F.col("t") < hit, F.lit(True)))


def gated(rows: DataFrame, p: Parameters = DEFAULTS, low: float | Column | None = None, high: float | Column | None = None, on: bool = True) -> DataFrame:
    """rows (with s) with gate: emergency, masked (not allowed where enough is known), rejected (concluded too early) or pass."""
    low, high = p.tau_low if low is None else low, p.tau_high if high is None else high
    if not on:
        return rows.withColumn("gate", F.when(F.col("emergency_hit"), "emergency").otherwise("pass"))
    talked = F.coalesce(F.lag("u").over(Window.partitionBy(*TRAJECTORY).orderBy("t")) == "TALK", F.lit(False))
    enough, little = F.coalesce(F.col("s") >= high, F.lit(False)), F.coalesce(F.col("s") < low, F.lit(False))
    masked = enough & ((F.col("u") == "WEN") | ((F.col("u") == "TALK") & talked))
    return rows.withColumn("gate", F.when(F.col("emergency_hit"), "emergency").when(masked, "masked").when(little & (F.col("u") == "DIG"), "rejected").otherwise("pass"))


def disclosure(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """rows (required, omega: the case's facts to ask for and their weights) with disclose: the unconfirmed one of greatest
    weighted surprise, the smallest on ties, null if none is left."""
    rows = rows.withColumn("open_", F.array_except("required", "confirmed"))
    score = lambda k: F.get(F.col("omega"), k) * beliefs.surprise(F.get(F.col("belief"), k), p.floor)
    best = F.array_max(F.transform("open_", lambda k: F.struct(score(k).alias("score"), (-k).alias("k"))))
    return rows.withColumn("disclose", -best["k"]).drop("open_")


def disclosures_left(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """Per trajectory: rejections, disclosures (one per rejection, as many as there are required facts at most), and whether
    the turns stay within budget plus required facts."""
    out = rows.groupBy(*TRAJECTORY).agg(F.count_if(F.col("gate") == "rejected").alias("rejections"), F.max(F.size("required")).alias("required"), F.count("*").alias("turns"), F.max("real_turns").alias("real_turns"))
    out = out.withColumn("disclosed", F.least("rejections", "required"))
    return out.withColumn("ends", F.col("turns") <= turn_budget(F.col("real_turns"), p) + F.col("required"))


def thresholds(rows: DataFrame, low: float = DEFAULTS.low_quantile, high: float = DEFAULTS.high_quantile) -> DataFrame:
    """tau_low and tau_high: exact quantiles of the last turns' sufficiency."""
    last = rows.groupBy(*TRAJECTORY).agg(F.max_by("s", "t").alias("s"))
    return quantiles(last, "s", {"tau_low": low, "tau_high": high})


def branches(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """rows (h, and voi: the value of information of the turn's best action, null if unknown) with branch: whether extra trajectories start
    here, because of either."""
    worth = F.coalesce(F.col("voi") > p.branch_voi, F.lit(False)) if "voi" in rows.columns else F.lit(False)
    return rows.withColumn("branch", worth | (F.col("h") > p.branch_entropy))


def gated_in(rows: DataFrame, stages: tuple[str, ...] = ("C3",), p: Parameters = DEFAULTS) -> DataFrame:
    """rows (s, stage) with gate: only in some stages of the curriculum is anything masked or rejected; emergencies count in all."""
    rows = gated(rows, p)
    return rows.withColumn("gate", F.when(F.col("stage").isin(*stages) | (F.col("gate") == "emergency"), F.col("gate")).otherwise("pass"))


def distinct_questions(rows: DataFrame, text: str) -> DataFrame:
    """Sampled questions of a turn, pairwise different."""
    return rows.dropDuplicates([*TRAJECTORY, "t", text])


def bucket(doctor_turns: Column, p: Parameters = DEFAULTS) -> Column:
    return F.when(doctor_turns <= p.short_turns, "C1").when(doctor_turns <= p.middle_turns, "C2").otherwise("C3")


def tercile_bounds(cases: DataFrame, column: str = "doctor_turns") -> DataFrame:
    return quantiles(cases, column, {"first": 1 / 3, "second": 2 / 3})


def early_rate(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """The share of trajectories that end at too little sufficiency, and quantiles of the last sufficiency."""
    last = rows.groupBy(*TRAJECTORY).agg(F.max_by("s", "t").alias("s"))
    rate = last.agg(F.avg(F.when(F.col("s") < p.tau_low, 1.0).otherwise(0.0)).alias("early_rate")).withColumn("k", F.lit(1))
    return rate.join(quantiles(last, "s", {f"s_{round(100 * q)}": q for q in (0.1, 0.5, 0.9)}).withColumn("k", F.lit(1)), "k").drop("k")


def stage_switch(ends: DataFrame, utility: float, early: float, p: Parameters = DEFAULTS) -> DataFrame:
    """Per stage: mean utility, early rate, and whether the next stage begins.  ends: stage, utility_end, s."""
    out = ends.groupBy("stage").agg(F.avg("utility_end").alias("mean_utility"), F.avg(F.when(F.col("s") < p.tau_low, 1.0).otherwise(0.0)).alias("early_rate"))
    return out.withColumn("switch", (F.col("mean_utility") >= utility) & (F.col("early_rate") <= early))


def replayed(cases: DataFrame, p: Parameters = DEFAULTS, key: str = "case_id") -> DataFrame:
    """The share of earlier cases that is replayed, chosen by a hash that other engines can work out too."""
    return cases.where(hash_number(F.col(key).cast("string")) % 1000 < round(1000 * p.replay))
