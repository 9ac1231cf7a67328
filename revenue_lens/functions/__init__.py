from revenue_lens.functions.calendar import month_index, week_end
from revenue_lens.functions.hashing import hash_int, hash_uniform
from revenue_lens.functions.money import from_cents, to_cents
from revenue_lens.functions.scoring import heuristic_logit, heuristic_probability, risk_tier

__all__ = [
    "from_cents",
    "hash_int",
    "hash_uniform",
    "heuristic_logit",
    "heuristic_probability",
    "month_index",
    "risk_tier",
    "to_cents",
    "week_end",
]
