"""Stream forms of the batch operators; each reuses the batch expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.functions import from_cents, to_cents, week_end
from revenue_lens.operators import alerts, drift
from revenue_lens.operators.churn import score_requests
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import DRIFT_FEATURES
from revenue_lens.sources.orders import split_requests


def weekly_revenue_stream(purchases: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Revenue per week ending Monday from (ts, revenue) events.

    The event time is the closing Monday itself, so a stream week holds exactly the orders
    of the batch week in any session time zone. State is one row per open week; a week is
    emitted, and later events for it left out, once an event arrives that lies more than
    ``lateness`` past it in closing time. Empty weeks are not emitted; the batch operator
    fills them.
    """
    closing = week_end(F.col("ts")).cast("timestamp")
    weeks = purchases.withColumn("closing", closing).withWatermark("closing", lateness).groupBy("closing")
    return weeks.agg(F.sum(to_cents(F.col("revenue"))).alias("cents")).select(
        F.to_date("closing").alias("week_end"), from_cents(F.col("cents")).alias("revenue")
    )


def score_request_stream(requests: DataFrame, model: PipelineModel | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests, rejected requests with the reason); stateless."""
    valid, rejected = split_requests(requests)
    return score_requests(valid, model), rejected


def drift_alert_writer(baseline: DataFrame, alert_path: str, thresholds: dict[str, float] | None = None) -> Callable:
    """A ``foreachBatch`` function: drift of each batch of customer features against the baseline.

    The baseline is read once, for its bin counts; a batch meets these, and the baseline itself only for a feature that
    leaves its range. Violations are written to one folder per batch, so a replayed batch replaces its own.
    """
    bins = drift.baseline_bins(baseline, [f for f in DRIFT_FEATURES if f in baseline.columns])

    def write(batch: DataFrame, batch_id: int) -> None:
        found = drift.psi_from_bins(bins, baseline, materialize(batch))
        report = found.withColumn("alert_level", drift.alert_level(F.col("psi")))
        metric = alerts.metric_row(drift.drift_summary(report), "max_psi", "max_psi")
        violations = alerts.evaluate(metric, alerts.rules(batch.sparkSession, thresholds=thresholds))
        violations.withColumn("ts", F.current_timestamp()).write.mode("overwrite").json(f"{alert_path}/batch={batch_id}")

    return write
