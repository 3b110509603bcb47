"""Measures of beliefs: arrays of probabilities over facts, then diagnoses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def entropy(belief: Column) -> Column:
    """Bits; atoms of probability zero add nothing."""
    return -F.aggregate(belief, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def atoms(facts: Column, diagnoses: Column) -> Column:
    """A case's atoms: its facts, then its diagnoses; ids of the two don't overlap."""
    return F.concat(facts, diagnoses)


def expected(belief: Column, utility: Column) -> Column:
    """The mean of utility, an array alike, under the belief."""
    return _sum(F.zip_with(belief, utility, lambda p, u: p * u))


def potential(bits: Column, utility: Column, alpha: float | Column, beta: float | Column) -> Column:
    alpha, beta = (x if isinstance(x, Column) else F.lit(float(x)) for x in (alpha, beta))
    return alpha * ((1.0 - beta) * -bits + beta * utility)


def surprise(probability: Column, floor: float | Column) -> Column:
    """Bits of an event of that probability, which counts as floor at least."""
    return -F.log2(F.greatest(probability, floor if isinstance(floor, Column) else F.lit(float(floor))))


def occupied(belief: Column, facts: int, threshold: float) -> Column:
    """Which of the first atoms have the threshold's probability, as bits: fact k is bit k.  Up to 62 facts fit."""
    if facts > 62:
        raise ValueError("occupancy bits hold 62 facts at most")
    flags = F.transform(F.slice(belief, 1, facts), lambda p, k: F.when(p >= threshold, F.expr("1L")).otherwise(F.lit(0).cast("long")))
    return F.aggregate(F.reverse(flags), F.lit(0).cast("long"), lambda a, b: a * 2 + b)


def sharpened(weights: Column, power: Column) -> Column:
    """|w| ** power, normalised to sum to one."""
    raised = F.transform(weights, lambda w: F.pow(F.abs(w.cast("double")), power))
    return F.transform(raised, lambda r: r / _sum(raised))
