"""Business thresholds used by the operators.

Every operator takes a ``Thresholds`` (or the single number it needs) as an
argument, so nothing is read from global state.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # Defaults that results have to agree on.
    financial_tolerance: float = 0.05
    zscore_limit: float = 3.0
    zscore_max_removed_share: float = 0.05
    iqr_factor: float = 3.0
    pareto_target: float = 0.80
    abc_a_share: float = 0.70
    abc_b_share: float = 0.90
    bleeder_quantile: float = 0.75
    discount_cap: float = 0.25
    churn_max_orders: int = 3
    sample_rows: int = 15000
    seed: int = 42


DEFAULTS = Thresholds()
