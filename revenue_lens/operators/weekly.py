from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.functions import from_cents, to_cents, week_end


def weekly_revenue(orders: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Revenue per week ending Monday, with empty weeks filled by 0.

    ``keys`` gives one series per key; each runs from its first to its last week. The
    windows below run over weekly totals, so a series is never longer than the calendar.
    """
    keys = keys or []
    totals = orders.groupBy(*keys, week_end(F.col("order_date")).alias("week_end")).agg(
        F.sum(to_cents(F.col("revenue"))).alias("cents"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    in_order = series.orderBy("week_end")
    following = F.lead("week_end").over(in_order)
    starts_late = (F.lag("week_end").over(in_order).isNull()) & (F.col("first_day") > F.date_sub("week_end", 6))
    ends_early = following.isNull() & (F.col("last_day") < F.col("week_end"))
    return (
        totals.withColumns(
            {
                "is_partial": starts_late | ends_early,
                "weeks": F.sequence(
                    "week_end", F.coalesce(F.date_sub(following, 7), F.col("week_end")), F.expr("interval 7 days")
                ),
            }
        )
        .select(*keys, "cents", "is_partial", F.posexplode("weeks").alias("gap", "week_end"))
        .select(
            *keys,
            "week_end",
            F.when(F.col("gap") == 0, from_cents(F.col("cents"))).otherwise(0.0).alias("revenue"),
            ((F.col("gap") == 0) & F.col("is_partial")).alias("is_partial"),
        )
    )
