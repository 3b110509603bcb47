"""Group sizes, cluster baselines, advantages and the clipped objective."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import beliefs
from ..plans.parameters import DEFAULTS, Parameters
from .ranks import placed


def group_sizes(cases: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """cases (batch, case_id, h0) with n, and granted: n as far as the batch's quota reaches, highest entropy first.

    Windows are per batch, whose size is bounded by training.
    """
    rows = cases.withColumn("n", F.ceil(p.group_min + (p.group_max - p.group_min) * F.col("h0") / p.most_bits).cast("long"))
    order = Window.partitionBy("batch").orderBy(F.desc("h0"), "case_id")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = F.count("*").over(Window.partitionBy("batch")) * p.group_mean
    return rows.withColumn("granted", F.greatest(F.lit(0), F.least(F.col("n"), quota - before)).cast("long"))


def clustered(rows: DataFrame, centroids: list[int], p: Parameters = DEFAULTS) -> DataFrame:
    """rows with cluster: the centroid (occupancy bits) nearest in Hamming distance, the first on ties."""
    bits = beliefs.occupied(F.col("belief"), p.facts, p.occupancy)
    near = F.array_min(F.array(*(F.struct(F.bit_count(bits.bitwiseXOR(F.lit(c).cast("long"))).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centroids))))
    return rows.withColumn("cluster", near["c"])


def advantages(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """rows (batch, cluster, reward, rejected, normalised) with baseline and advantage.

    Baselines are means over a cluster's turns, or the batch's where it has too few; rejected and emergency turns don't count in
    them.  A rejected conclusion gets the penalty.  Means are aggregated before anything is joined back, so a hot cluster is no hot task.
    """
    counted = rows.where(F.col("normalised") & ~F.col("rejected")).groupBy("batch", "cluster").agg(F.sum("reward").alias("sum"), F.count("*").alias("n"))
    whole = counted.groupBy("batch").agg(F.sum("sum").alias("all_sum"), F.sum("n").alias("all_n"))
    base = rows.select("batch", "cluster").distinct().join(counted, ["batch", "cluster"], "left").join(whole, "batch", "left")
    mean = F.when(F.col("n") >= p.cluster_least, F.col("sum") / F.col("n")).otherwise(F.col("all_sum") / F.col("all_n"))
    out = rows.join(base.select("batch", "cluster", mean.alias("baseline")), ["batch", "cluster"])
    return out.withColumn("advantage", F.when(F.col("rejected"), F.lit(-p.early_penalty)).otherwise(F.col("reward") - F.col("baseline")))


def objective(rows: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """Per batch: the clipped objective (means over turns, then trajectories, then cases), the KL term, and the first less the weighted second."""
    ratio = F.exp(F.col("logp_new") - F.col("logp_old"))
    term = F.least(ratio * F.col("advantage"), F.greatest(F.lit(1 - p.clip), F.least(F.lit(1 + p.clip), ratio)) * F.col("advantage"))
    by_turn = rows.groupBy("batch", "case_id", "traj_id").agg(F.avg(term).alias("v"), F.avg(F.col("logp_old") - F.col("logp_new")).alias("kl"))
    by_case = by_turn.groupBy("batch", "case_id").agg(F.avg("v").alias("v"), F.avg("kl").alias("kl"))
    out = by_case.groupBy("batch").agg(F.avg("v").alias("clipped"), F.avg("kl").alias("kl"))
    return out.withColumn("objective", F.col("clipped") - p.kl_weight * F.col("kl"))


def kl_coefficient(steps: DataFrame, p: Parameters = DEFAULTS, start: float = 1.0) -> DataFrame:
    """steps (batch, kl) with coefficient: doubled after a KL over twice the target, halved after one under half of it."""
    turn = F.when(F.col("kl") > 2 * p.kl_target, 1).when(F.col("kl") < 0.5 * p.kl_target, -1).otherwise(0)
    rows, _ = placed(steps.withColumn("turn_", turn), "batch", F.col("turn_"))
    return rows.withColumn("coefficient", F.lit(start) * F.pow(F.lit(2.0), F.col("before") + F.col("turn_"))).drop("turn_", "before")


def budget_parity(runs: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """runs (method, calls, tokens): totals per method and whether they are within the tolerance of the mean of methods."""
    sums = runs.groupBy("method").agg(F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens"))
    w = Window.partitionBy(F.lit(1))
    near = lambda c: F.abs(F.col(c) / F.avg(c).over(w) - 1) <= p.budget_tolerance
    return sums.withColumn("matched", near("calls") & near("tokens"))


def allocations(cases: DataFrame, p: Parameters = DEFAULTS) -> DataFrame:
    """cases (batch, case_id, h0, variance) with each rule's share of the batch's trajectories: by entropy, evenly, by the variance of returns."""
    w = Window.partitionBy("batch")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(w)), 1 / F.count("*").over(w))
    return cases.withColumn("by_entropy", share("h0")).withColumn("even", 1 / F.count("*").over(w)).withColumn("by_variance", share("variance"))
