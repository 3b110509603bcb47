"""Evaluation statistics.  Rankings and numberings go by ranges of values, so that no task holds all cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.parameters import DEFAULTS, Parameters
from .ranks import hash_number, placed, ranked


def correlation(x: Column, y: Column) -> Column:
    """Pearson's, null where one side doesn't vary."""
    return F.when((F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """The correlation of ranks; ties share the mean of theirs."""
    rows = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))
    rows = ranked(ranked(rows, "x", "rx"), "y", "ry")
    return rows.agg(correlation(F.col("rx"), F.col("ry")).alias("rho"), F.count("*").alias("n"))


def calibration_error(rows: DataFrame, confidence: str, correct: str, p: Parameters = DEFAULTS) -> DataFrame:
    """Expected calibration error over equal bins of confidence."""
    at = F.least(F.floor(F.col(confidence) * p.bins), F.lit(p.bins - 1))
    bins = rows.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"), F.avg(confidence).alias("confidence"))
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def bootstrap(cases: DataFrame, value: str, replicates: int = DEFAULTS.replicates, key: str = "case_id") -> DataFrame:
    """The mean with a 95 % interval over `replicates` means; replicates draw cases by a hash of (replicate, slot) that other engines share.

    Each replicate's slots are rows of a join on the drawn index, so the work spreads over all replicates.
    """
    numbered, n = placed(cases.select(key, F.col(value).alias("v")), key, F.lit(1))
    numbered = numbered.select(F.col("before").cast("long").alias("i"), "v")
    if not n:
        return cases.agg(F.avg(value).alias("mean"), F.percentile(value, 0.025).alias("low"), F.percentile(value, 0.975).alias("high"))
    slots = cases.sparkSession.range(n * replicates).select((F.col("id") % n).alias("q"), F.expr(f"id div {n}L + 1").alias("r"))
    drawn = slots.select("r", (hash_number(F.concat_ws(":", F.col("r").cast("string"), F.col("q").cast("string"))) % n).alias("i"))
    means = drawn.join(numbered, "i").groupBy("r").agg(F.avg("v").alias("m"))
    spread = means.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high")).withColumn("k", F.lit(1))
    return cases.agg(F.avg(value).alias("mean")).withColumn("k", F.lit(1)).join(spread, "k").drop("k")


def holm(tests: DataFrame) -> DataFrame:
    """tests (hypothesis, p) with adjusted p-values."""
    order = Window.orderBy("p", "hypothesis")
    m = F.count("*").over(Window.partitionBy(F.lit(1)))
    rows = tests.withColumn("step", F.least(F.lit(1.0), (m - F.row_number().over(order) + 1) * F.col("p")))
    return rows.select("hypothesis", "p", F.max("step").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("adjusted"))


def agreement(ratings: DataFrame) -> DataFrame:
    """ICC(2,1) of ratings (subject, rater, score), a complete two-way table; null if its denominator is zero."""
    subjects = ratings.groupBy("subject").agg(F.avg("score").alias("m"))
    raters = ratings.groupBy("rater").agg(F.avg("score").alias("m"))
    one = F.lit(1).alias("one")
    whole = ratings.agg(F.count("*").alias("cells"), F.var_pop("score").alias("v"))
    s = subjects.agg(F.count("*").alias("n"), F.var_pop("m").alias("vs"))
    r = raters.agg(F.count("*").alias("k"), F.var_pop("m").alias("vr"))
    t = whole.select(one, "*").join(s.select(one, "*"), "one").join(r.select(one, "*"), "one")
    n, k = F.col("n"), F.col("k")
    rows_ss, columns_ss, all_ss = k * n * F.col("vs"), n * k * F.col("vr"), n * k * F.col("v")
    msr, msc = F.try_divide(rows_ss, n - 1), F.try_divide(columns_ss, k - 1)
    mse = F.try_divide(all_ss - rows_ss - columns_ss, (n - 1) * (k - 1))
    return t.select(n.alias("subjects"), k.alias("raters"), F.try_divide(msr - mse, msr + (k - 1) * mse + k * (msc - mse) / n).alias("icc"))


def leave_one_out(rows: DataFrame, source: str, value: str) -> DataFrame:
    """Per source: the mean over all other sources and over itself.  Sums are taken once, nothing is joined row by row."""
    sums = rows.groupBy(source).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    w = Window.partitionBy(F.lit(1))
    return sums.select(F.col(source).alias("held_out"), F.try_divide(F.sum("s").over(w) - F.col("s"), (F.sum("n").over(w) - F.col("n"))).alias("others"), F.try_divide("s", "n").alias("own"))


def correlations(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per pair of columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = rows.agg(*(correlation(F.col(a), F.col(b)).alias(f"{a}~{b}") for a, b in pairs))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}~{b}`").alias("r")) for a, b in pairs))).alias("p")).select("p.*")


def variances(rows: DataFrame) -> DataFrame:
    """Variance of rewards by turn and of returns by trajectory."""
    returns = rows.groupBy("case_id", "traj_id").agg(F.sum("reward").alias("total"), F.avg("reward").alias("mean"))
    turns = rows.agg(F.var_samp("reward").alias("by_turn")).withColumn("k", F.lit(1))
    return turns.join(returns.agg(F.var_samp("total").alias("by_trajectory"), F.var_samp("mean").alias("by_mean")).withColumn("k", F.lit(1)), "k").drop("k")


def crosstab(rows: DataFrame, first: str, second: str) -> DataFrame:
    return rows.groupBy(first, second).agg(F.count("*").alias("n"))


def split_audit(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("split").agg(F.count("*").alias("n"))


def recall(rows: DataFrame, true: str, found: str) -> DataFrame:
    """The share of true cases that were found; null without any."""
    return rows.agg(F.try_divide(F.count_if(F.col(true) & F.col(found)), F.count_if(F.col(true))).alias("recall"), F.count_if(F.col(true)).alias("n"))


def distributions(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: number of values, mean, standard deviation, least and greatest.  One pass over the rows."""
    wide = rows.agg(*(F.struct(F.lit(c).alias("signal"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd"), F.min(c).alias("least"), F.max(c).alias("greatest")).alias(c) for c in columns))
    return wide.select(F.explode(F.array(*columns)).alias("d")).select("d.*")


def share(rows: DataFrame, part: str, whole: str) -> DataFrame:
    """Sum of part over sum of whole."""
    return rows.agg(F.try_divide(F.sum(part), F.sum(whole)).alias("share"))


def bias_bound(rows: DataFrame, first: str, second: str, bound: float) -> DataFrame:
    """How far two estimators' process rewards are apart, and whether that is within twice the bound."""
    gap = F.max(F.abs(F.col(first) - F.col(second)))
    return rows.agg(gap.alias("gap"), (gap <= 2 * bound).alias("within"))
