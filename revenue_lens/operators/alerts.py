"""Threshold alerts: a table of metrics meets a table of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default thresholds.
CHURN_SIGMAS = 3.0
HISTORICAL_CHURN = (0.20, 0.05)
MIN_MARGIN = -0.01
MAX_MAPE = 0.05
MAX_PSI = 0.15
MAX_MODEL_AGE_DAYS = 30

# Rule, metric, severity, violated when value is above (1) or below (-1) the threshold.
RULES = [
    ("churn_spike", "churn_rate", "WARNING", 1),
    ("margin_decline", "margin", "CRITICAL", -1),
    ("forecast_error", "mape", "CAUTION", 1),
    ("data_drift", "max_psi", "WARNING", 1),
    ("model_staleness", "model_age_days", "CAUTION", 1),
]

RULE_SCHEMA = "rule string, metric string, severity string, direction int, threshold double"


def rules(
    spark: SparkSession,
    historical_mean: float = HISTORICAL_CHURN[0],
    historical_std: float = HISTORICAL_CHURN[1],
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """The rule table; an explicit threshold replaces the default, 0 included."""
    limits = {
        "churn_spike": historical_mean + CHURN_SIGMAS * historical_std,
        "margin_decline": MIN_MARGIN,
        "forecast_error": MAX_MAPE,
        "data_drift": MAX_PSI,
        "model_staleness": float(MAX_MODEL_AGE_DAYS),
    } | (thresholds or {})
    return spark.createDataFrame([(*r, float(limits[r[0]])) for r in RULES], RULE_SCHEMA)


def _message() -> Column:
    """The wording of each rule's message."""
    value, limit = F.col("value"), F.col("threshold")
    wording = {
        "churn_spike": F.format_string(
            "Churn rate %.1f%% exceeds threshold %.1f%% (mean + %sσ)", value * 100, limit * 100, F.lit(str(CHURN_SIGMAS))
        ),
        "margin_decline": F.format_string("Net margin %.2f%% below minimum %.2f%%", value * 100, limit * 100),
        "forecast_error": F.format_string("Forecast MAPE %.2f%% exceeds %.2f%%", value * 100, limit * 100),
        "data_drift": F.format_string("Data drift PSI %.3f exceeds %.3f", value, limit),
        "model_staleness": F.format_string(
            "Model last trained %d days ago (limit: %d)", value.cast("bigint"), limit.cast("bigint")
        ),
    }
    text = F.lit(None).cast("string")
    for rule, message in wording.items():
        text = F.when(F.col("rule") == rule, message).otherwise(text)
    return text


def evaluate(metrics: DataFrame, rule_table: DataFrame) -> DataFrame:
    """Violated rules for a long table (metric, value, ...); further columns pass through.

    The rule table has one row per rule, which bounds the broadcast.
    """
    return (
        metrics.join(F.broadcast(rule_table), "metric")
        .where(F.when(F.col("direction") > 0, F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold")))
        .withColumn("message", _message())
        .drop("direction", "metric")
    )


def metric_row(df: DataFrame, metric: str, column: str) -> DataFrame:
    """One column of a table as (metric, value) rows."""
    return df.select(F.lit(metric).alias("metric"), F.col(column).cast("double").alias("value"))


def model_ages(registry: DataFrame, now: Column | None = None) -> DataFrame:
    """Age in whole days of the latest version of every model."""
    latest = registry.groupBy("name").agg(F.max_by("created_at", "version").alias("created_at"))
    age = F.floor((F.unix_seconds(now if now is not None else F.current_timestamp()) - F.unix_seconds("created_at")) / 86400)
    return latest.select("name", F.lit("model_age_days").alias("metric"), age.cast("double").alias("value"))


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append to the alert log (JSON lines)."""
    alerts.withColumn("ts", F.current_timestamp()).write.mode("append").json(path)
