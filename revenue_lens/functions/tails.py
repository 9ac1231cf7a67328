"""Upper tail probabilities used for p-values; small closed forms on scalars."""

from __future__ import annotations

import math


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for an integer number of degrees of freedom."""
    if x <= 0 or df < 1:
        return 1.0
    half = x / 2
    if df % 2 == 0:
        term = total = math.exp(-half)
        for j in range(1, df // 2):
            term *= half / j
            total += term
        return min(total, 1.0)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for j in range(1, (df - 1) // 2 + 1):
        total += term
        term *= half / (j + 0.5)
    return min(total, 1.0)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))
