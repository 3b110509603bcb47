"""Parameters of the analyses, with defaults; those marked (given) are fixed by the method, the others are this package's."""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class Parameters:
    facts: int = 54
    diagnoses: int = 10
    alpha: float = 1.0
    beta: float = 0.5
    fact_weight: float = 0.1
    outcome_weight: float = 1.0
    cost_weight: float = 0.01
    turn_cost: float = 1.0
    token_cost: float = 0.01
    delay_penalty: float = 1.0
    early_penalty: float = 0.5  # of a rejected conclusion
    tau_low: float = 0.2
    tau_high: float = 0.6
    branch_entropy: float = 4.5
    branch_voi: float = 0.25
    group_min: int = 2
    group_max: int = 8
    group_mean: int = 4
    occupancy: float = 0.02
    cluster_least: int = 4  # (given)
    clip: float = 0.2
    budget_most: int = 20  # (given)
    budget_more: int = 2  # (given)
    budget_least: int = 3  # (given)
    low_quantile: float = 0.25  # (given)
    high_quantile: float = 0.75  # (given)
    short_turns: int = 5  # (given)
    middle_turns: int = 10  # (given)
    replay: float = 0.3  # (given)
    replicates: int = 1000  # (given)
    budget_tolerance: float = 0.02  # (given)
    kl_target: float = 0.05
    kl_weight: float = 0.1
    bins: int = 10

    @property
    def atoms(self) -> int:
        return self.facts + self.diagnoses

    @property
    def floor(self) -> float:
        """The least probability that counts: 1 / (2 (K + D)) (given)."""
        return 1.0 / (2 * self.atoms)

    @property
    def most_bits(self) -> float:
        return math.log2(self.atoms)


DEFAULTS = Parameters()
