"""Exact ROC AUC, average precision and calibration of scored labels.

Rows collapse to one row per (model, score); running totals over the scores are
distributed, so neither a frequent score nor many distinct scores overload one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators.ranking import running_totals

CALIBRATION_BINS = 8


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """(model, auc_roc, pr_auc, positives, negatives) from (model, label, prob) rows.

    AUC counts tied pairs half; average precision steps by distinct threshold. Both are
    NULL when one class is missing.
    """
    return metrics_of_counts(
        scored.groupBy("model", "prob").agg(
            F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") != 1, 1)).alias("neg")
        )
    )


def metrics_of_counts(by_score: DataFrame) -> DataFrame:
    """The same from one row per (model, prob) with the counts ``pos`` and ``neg``."""
    at = running_totals(by_score, "model", "prob", ["pos", "neg"])
    wins = F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)
    true_positives = F.col("all_pos") - F.col("cum_pos") + F.col("pos")
    false_positives = F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    precision = F.when(F.col("pos") > 0, F.col("pos") * true_positives / (true_positives + false_positives)).otherwise(0.0)
    positives, negatives = F.first("all_pos"), F.first("all_neg")
    both = (positives > 0) & (negatives > 0)
    return at.groupBy("model").agg(
        F.when(both, F.sum(wins) / (positives.cast("double") * negatives)).alias("auc_roc"),
        F.when(both, F.sum(precision) / positives).alias("pr_auc"),
        positives.alias("positives"),
        negatives.alias("negatives"),
    )


def calibration(scored: DataFrame, bins: int = CALIBRATION_BINS) -> DataFrame:
    """Mean predicted and observed rate per uniform bin (lo, hi], the first including 0."""
    number = F.greatest(F.ceil(F.col("prob") * bins) - 1, F.lit(0)).cast("int")
    return scored.groupBy("model", number.alias("bin")).agg(
        F.avg("label").alias("observed"), F.avg("prob").alias("predicted"), F.count(F.lit(1)).alias("n")
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by AUC, best first."""
    return metrics.orderBy(F.desc_nulls_last("auc_roc"), "model")
