"""Rewards of logged turns.

A log has case_id, traj_id, t, u ('WEN' asks, 'TALK', 'DIG' concludes), n_tok, belief, confirmed, and of the case utility
(per atom) and r_out.  All windows are per trajectory, so a log partitioned by trajectory is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import beliefs
from ..plans.parameters import DEFAULTS, Parameters

TRAJECTORY = ("case_id", "traj_id")


def _turns(*more):
    return Window.partitionBy(*TRAJECTORY).orderBy("t", *more)


def _whole():
    return Window.partitionBy(*TRAJECTORY)


def measured(log: DataFrame, p: Parameters = DEFAULTS, alpha: float | Column | None = None, beta: float | Column | None = None) -> DataFrame:
    """log with h, phi, psi, ig, dphi, r_p and s: differences to the next turn are null on the last one, r_p is 0 there.

    s, the sufficiency, is null where the first belief has no entropy; it isn't clamped, since entropy may rise.
    """
    alpha, beta = p.alpha if alpha is None else alpha, p.beta if beta is None else beta
    w = _turns()
    rows = log.withColumn("h", beliefs.entropy(F.col("belief"))).withColumn("phi", beliefs.expected(F.col("belief"), F.col("utility")))
    rows = rows.withColumn("psi", beliefs.potential(F.col("h"), F.col("phi"), alpha, beta))
    rows = rows.withColumn("ig", F.col("h") - F.lead("h").over(w)).withColumn("dphi", F.lead("phi").over(w) - F.col("phi"))
    rows = rows.withColumn("r_p", F.coalesce(F.lead("psi").over(w) - F.col("psi"), F.lit(0.0))).withColumn("h0", F.first("h").over(w))
    return rows.withColumn("s", 1.0 - F.try_divide("h", F.nullif("h0", F.lit(0.0))))


def fact_reward(log: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """log with new_facts (confirmed now and not the turn before) and r_f, their surprise under the turn's belief."""
    before = F.coalesce(F.lag("confirmed").over(_turns()), F.expr("cast(array() as array<int>)"))
    rows = log.withColumn("new_facts", F.array_sort(F.array_except("confirmed", before)))
    bits = F.transform("new_facts", lambda k: beliefs.surprise(F.get(F.col("belief"), k), p.floor))
    return rows.withColumn("r_f", F.lit(p.fact_weight) * F.aggregate(bits, F.lit(0.0), lambda a, x: a + x))


def terminal(log: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """log with utility_end: what the outcome is worth less the cost of the trajectory's turns and tokens."""
    w = _whole()
    cost = p.turn_cost * F.count("*").over(w) + p.token_cost * F.sum("n_tok").over(w)
    return log.withColumn("utility_end", p.outcome_weight * F.col("r_out") - p.cost_weight * cost)


def rewarded(log: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """measured, fact_reward and terminal, with rejected, paid and reward.

    A conclusion at too little sufficiency is rejected; the first one that isn't pays the terminal utility.
    """
    rows = terminal(fact_reward(measured(log, p), p), p)
    rows = rows.withColumn("rejected", (F.col("u") == "DIG") & F.coalesce(F.col("s") < p.tau_low, F.lit(False)))
    accepted = (F.col("u") == "DIG") & ~F.col("rejected")
    first = F.min(F.when(accepted, F.col("t"))).over(_whole())
    rows = rows.withColumn("paid", F.coalesce(F.col("t") == first, F.lit(False)))
    return rows.withColumn("reward", F.col("r_p") + F.col("r_f") + F.when(F.col("paid"), F.col("utility_end")).otherwise(0.0))


def returns(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """Per trajectory: the sum of rewards, its parts, the residual psi_T - psi_0 and whether that keeps its bounds."""
    out = rows.groupBy(*TRAJECTORY).agg(
        F.sum("reward").alias("total"),
        F.sum("r_f").alias("facts"),
        F.sum(F.when(F.col("paid"), F.col("utility_end")).otherwise(0.0)).alias("end"),
        (F.max_by("psi", "t") - F.min_by("psi", "t")).alias("residual"),
        F.min_by("h", "t").alias("h0"),
        F.max_by("h", "t").alias("h_last"),
        F.max("t").alias("last"),
    )
    calm = F.col("h_last") <= F.col("h0")
    low = F.when(calm, F.lit(-p.alpha * p.beta)).otherwise(F.lit(-p.alpha * ((1 - p.beta) * p.most_bits + p.beta)))
    high = p.alpha * ((1 - p.beta) * F.col("h0") + p.beta)
    out = out.withColumn("low", low).withColumn("high", high).withColumn("in_bounds", (F.col("residual") >= low - 1e-9) & (~calm | (F.col("residual") <= high + 1e-9)))
    return out.withColumn("adds_up", F.abs(F.col("total") - F.col("end") - F.col("residual") - F.col("facts")) < 1e-6)


def signals(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """rows (measured, with new_facts) with consistency, the mean probability that the belief gave the facts that came, 0 if none did;
    and answer, the change to the next turn of the probability of the diagnosis that is likeliest in the end (null on the last)."""
    given = F.transform("new_facts", lambda k: F.get(F.col("belief"), k))
    rows = rows.withColumn("consistency", F.when(F.size(given) > 0, F.aggregate(given, F.lit(0.0), lambda a, x: a + x) / F.size(given)).otherwise(0.0))
    last = F.slice(F.max_by("belief", "t").over(_whole()), p.facts + 1, p.diagnoses)
    rows = rows.withColumn("answer_", F.get(F.col("belief"), (F.array_position(last, F.array_max(last)) - 1 + p.facts).cast("int")))
    return rows.withColumn("answer", F.lead("answer_").over(_turns()) - F.col("answer_")).drop("answer_")


def value_of_information(samples: DataFrame) -> DataFrame:
    """Mean gain in potential per (case_id, traj_id, t, action) over logged sampled observations (psi_after, psi)."""
    return samples.groupBy(*TRAJECTORY, "t", "action").agg(F.avg(F.col("psi_after") - F.col("psi")).alias("voi"), F.count("*").alias("samples"))
