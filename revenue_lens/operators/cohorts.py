"""Retention by month of first purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.functions import month_index
from revenue_lens.operators.storage import materialize

# The presentation table shows the first 12 cohorts and the first 13 existing periods.
COHORTS = 12
PERIODS = 13


def cohort_activity(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Active customers per (cohort, period_index), with the cohort size.

    Orders shrink to distinct customer-months before anything else, so neither the window
    over a customer nor the final counts depend on how many orders one customer has.
    """
    months = (
        orders.where(F.col("order_date") <= F.lit(as_of))
        .select("customer_id", F.trunc("order_date", "MM").alias("month"))
        .distinct()
        .withColumn("cohort", F.min("month").over(Window.partitionBy("customer_id")))
    )
    active = months.groupBy(
        "cohort", (month_index(F.col("month")) - month_index(F.col("cohort"))).cast("bigint").alias("period_index")
    ).agg(F.count(F.lit(1)).alias("active"))
    # Everybody is active in period 0, so its count is the cohort size.
    size = F.max(F.when(F.col("period_index") == 0, F.col("active"))).over(Window.partitionBy("cohort"))
    return active.withColumn("cohort_size", size)


def cohort_retention(orders: DataFrame, as_of: dt.date, cohorts: int | None = None, periods: int | None = None) -> DataFrame:
    """Retention of every cohort in every existing period, one row per cell; ``cohorts`` and
    ``periods`` keep the first ones only.

    Cells without orders are 0; ``is_observable`` is false where the period lies after
    ``as_of``. All windows run over cohort x period counts, bounded by the calendar.
    """
    activity = cohort_activity(orders, as_of)
    whole = Window.partitionBy(F.lit(0))
    kept = activity.withColumns(
        {
            "cohort_rank": F.dense_rank().over(whole.orderBy("cohort")),
            "indexes": F.collect_set("period_index").over(whole),
        }
    )
    if cohorts is not None:
        kept = kept.where(F.col("cohort_rank") <= cohorts)
    indexes = F.array_sort(F.first("indexes"))
    by_cohort = kept.groupBy("cohort", "cohort_size").agg(
        F.map_from_entries(F.collect_list(F.struct("period_index", "active"))).alias("active_in"),
        (indexes if periods is None else F.slice(indexes, 1, periods)).alias("indexes"),
    )
    cells = by_cohort.select("cohort", "cohort_size", "active_in", F.explode("indexes").alias("period_index"))
    active = F.coalesce(F.element_at("active_in", F.col("period_index")), F.lit(0))
    observable = month_index(F.col("cohort")) + F.col("period_index") <= month_index(F.lit(as_of))
    return cells.select(
        "cohort",
        "period_index",
        "cohort_size",
        active.alias("active"),
        (active / F.col("cohort_size")).alias("retention"),
        observable.alias("is_observable"),
    )


def cohort_retention_table(orders: DataFrame, as_of: dt.date, cohorts: int | None = None, periods: int | None = None) -> DataFrame:
    """The same cells as one row per cohort and one column ``m<period_index>`` per period."""
    cells = materialize(cohort_retention(orders, as_of, cohorts, periods))
    shown = sorted(r[0] for r in cells.select("period_index").distinct().collect())
    return (
        cells.withColumn("period", F.concat(F.lit("m"), F.col("period_index").cast("string")))
        .groupBy("cohort")
        .pivot("period", [f"m{i}" for i in shown])
        .agg(F.first("retention"))
    )
