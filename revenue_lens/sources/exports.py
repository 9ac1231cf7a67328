"""Star-schema tables and their files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the customer dimension.
DIMENSION_COLUMNS = [
    "customer_id",
    "first_purchase",
    "last_purchase",
    "recency_days",
    "frequency_365d",
    "monetary_365d",
    "tenure_days",
    "rfm_segment",
    "kmeans_cluster",
    "churned",
    "clv_proxy",
]


def customers_dim(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return customers.select(*DIMENSION_COLUMNS, F.lit(as_of.isoformat()).alias("as_of_date"))


def orders_fact(orders: DataFrame) -> DataFrame:
    day = F.date_format("order_date", "yyyy-MM-dd")
    return orders.select("customer_id", day.alias("order_date"), "revenue", "category")


def model_scores_fact(
    customers: DataFrame, scores: DataFrame | None, as_of: dt.date, best_forecast: str | None, last_week_revenue: float | None
) -> DataFrame:
    """Scores per customer; ``scores`` None means ``customers`` already carries ``churn_prob``."""
    scored = customers if scores is None else customers.join(scores, "customer_id", "left")
    return scored.select(
        "customer_id",
        F.lit(as_of.isoformat()).alias("as_of_date"),
        "rfm_segment",
        "kmeans_cluster",
        "churn_prob",
        "duration_days",
        "event_observed",
        F.lit(best_forecast or "n/a").alias("forecast_model_best"),
        F.lit(last_week_revenue).cast("double").alias("weekly_revenue_last"),
    )


def write_star_schema(dim: DataFrame, orders: DataFrame, scores: DataFrame, out_dir: str) -> None:
    """Each table as Parquet and CSV; dimension and scores are partitioned by snapshot date.

    Only the partitions written replace existing ones, so earlier snapshots stay.
    """
    for name, table, by in (("customers_dim", dim, ["as_of_date"]), ("orders_fact", orders, []), ("model_scores_fact", scores, ["as_of_date"])):
        writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
        writer.parquet(f"{out_dir}/{name}.parquet")
        table.write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}.csv")


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)
