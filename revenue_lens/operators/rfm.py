from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators.ranking import closing_ranks, part_of, rows_at_ranks

# Scored column per score, and the number of parts.
SCORED = {"R_score": "recency_days", "F_score": "frequency_365d", "M_score": "monetary_365d"}
QUINTILES = 5

# Ordered rules, first match wins.
SEGMENT_RULES = [
    ("champions", "R_score >= 4 AND F_score >= 4 AND M_score >= 4"),
    ("loyal", "R_score >= 3 AND F_score >= 3"),
    ("new_or_promising", "R_score >= 4 AND F_score <= 2"),
    ("at_risk", "R_score <= 2 AND F_score >= 3"),
    ("hibernating", "R_score <= 2 AND F_score <= 2"),
]
OTHER_SEGMENT = "other"
SEGMENTS = [name for name, _ in SEGMENT_RULES] + [OTHER_SEGMENT]


def quantile_parts(customers: DataFrame, scored: dict[str, str], parts: int, key: str = "customer_id") -> DataFrame:
    """Add for each ``{score: column}`` the equal-count part of the column, ties by ``key``.

    Only the closing rows of the parts are searched for, all columns together; assigning the
    parts is then a comparison in place. ``customers`` is read several times and never
    shuffled: pass a stored table.
    """
    cells = F.array(*[F.struct(F.lit(s).alias("score"), F.col(c).cast("double").alias("value")) for s, c in scored.items()])
    cuts = rows_at_ranks(customers.select(key, F.inline(cells)), "score", "value", key, lambda n: closing_ranks(n, parts))
    return customers.withColumns({s: part_of(F.col(c).cast("double"), F.col(key), cuts.get(s, [])) for s, c in scored.items()})


def add_rfm_segments(customers: DataFrame) -> DataFrame:
    """Quintile scores 1..5 (recency inverted after ranking) and the rule-based segment."""
    scored = quantile_parts(customers, SCORED, QUINTILES).withColumn("R_score", QUINTILES + 1 - F.col("R_score"))
    segment = F.lit(OTHER_SEGMENT)
    for name, rule in reversed(SEGMENT_RULES):
        segment = F.when(F.expr(rule), name).otherwise(segment)
    return scored.withColumns(
        {"rfm_score": F.concat(*[F.col(s).cast("string") for s in SCORED]), "rfm_segment": segment}
    )


def segment_profile(customers: DataFrame) -> DataFrame:
    """Size, revenue and churn rate per RFM segment."""
    return customers.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum(F.rint(F.col("monetary_365d") * 100).cast("bigint")) / 100.0).alias("revenue_365d"),
        F.avg("churned").alias("churn_rate"),
    )


def top_risk_decile(scored: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """The tenth of the customers with the highest probability, ties by customer id."""
    return quantile_parts(scored, {"risk_decile": probability}, 10).where("risk_decile = 10")
