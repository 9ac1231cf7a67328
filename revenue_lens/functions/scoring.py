from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the heuristic risk score.
HEURISTIC_WEIGHTS = {
    "recency_days": 0.004,
    "frequency_365d": -0.02,
    "monetary_365d": -0.0001,
    "tenure_days": 0.001,
}

# A probability strictly above the bound gets the tier.
RISK_TIERS = [("High", 0.6), ("Medium", 0.3)]
LOWEST_TIER = "Low"


def heuristic_logit() -> Column:
    terms = [F.lit(w) * F.col(c) for c, w in HEURISTIC_WEIGHTS.items()]
    return sum(terms[1:], terms[0])


def heuristic_probability() -> Column:
    return 1 / (1 + F.exp(-heuristic_logit()))


def risk_tier(probability: Column) -> Column:
    tier = F.lit(LOWEST_TIER)
    for name, bound in reversed(RISK_TIERS):
        tier = F.when(probability > bound, name).otherwise(tier)
    return tier
