"""Customer features kept up to date from a stream of orders.

The state is a log of day sums: every micro-batch adds a folder with one row per customer and day of its orders, so a replayed
batch replaces its own rows and an order may arrive in any batch, however late. ``merge`` folds the log into one
folder: one row per customer and day, and days that have left every window (the trailing year of the lagged snapshot)
as a single row per customer. A merge that breaks off leaves the log as it was. Reading adds up the last merge and
the batches after it, so the features equal the batch operator's over all orders received.

State grows with the customers and the days of their trailing windows, not with the orders; merges run as often as the
log's length asks for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.functions import to_cents
from revenue_lens.operators.customers import features_from_days
from revenue_lens.settings import FEATURE_LAG_DAYS, INACTIVE_DAYS, TRAILING_DAYS

_DAYS = "customer_id bigint, order_date date, first date, orders bigint, cents bigint"
_MERGES = "upto bigint, folded_until date"


def day_sums(orders: DataFrame) -> DataFrame:
    """(customer_id, order_date, first, orders, cents), one row per customer and day."""
    days = orders.select("customer_id", F.to_date("order_date").alias("order_date"), to_cents(F.col("revenue")).alias("cents"))
    sums = days.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("cents"))
    return sums.select("customer_id", "order_date", F.col("order_date").alias("first"), "orders", "cents")


class CustomerState:
    """The log under ``path``. Only one stream writes to it, and merges run between its batches."""

    def __init__(self, spark: SparkSession, path: str, lag_days: int = FEATURE_LAG_DAYS):
        self.spark, self.path, self.lag_days = spark, path.rstrip("/"), lag_days

    def writer(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function for orders (customer_id, order_date, revenue)."""

        def write(batch: DataFrame, batch_id: int) -> None:
            day_sums(batch).write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch_id}")

        return write

    def _last_merge(self) -> tuple[int, dt.date | None]:
        """The last batch that a complete merge holds, and the day until which it folded."""
        try:
            # One row a merge; it is written when the merge's rows are.
            last = self.spark.read.schema(_MERGES).parquet(f"{self.path}/merges").orderBy(F.desc("upto")).first()
        except AnalysisException:
            last = None
        return (last["upto"], last["folded_until"]) if last else (-1, None)

    def _batches(self, after: int) -> DataFrame:
        try:
            return self.spark.read.schema(f"{_DAYS}, batch bigint").parquet(f"{self.path}/batches").where(F.col("batch") > after)
        except AnalysisException:  # no batch yet
            return self.spark.createDataFrame([], f"{_DAYS}, batch bigint")

    def days(self) -> DataFrame:
        """Everything received: rows of days, and of days already folded."""
        upto, _ = self._last_merge()
        rows = self._batches(upto).drop("batch")
        return rows if upto < 0 else rows.unionByName(self.spark.read.schema(_DAYS).parquet(f"{self.path}/merged/upto={upto}"))

    def merge(self, until: dt.date) -> None:
        """Fold the log; features are asked for at ``until`` or later from now on."""
        upto, folded = self._last_merge()
        last = self._batches(upto).agg(F.max("batch").alias("n")).first()["n"]
        if last is None:
            return
        until = max(until, folded) if folded else until
        gone = F.col("order_date") <= F.date_sub(F.lit(until), TRAILING_DAYS + self.lag_days)
        # A folded row keeps its last day, which tells it from the days that count in a window.
        groups = self.days().groupBy("customer_id", gone.alias("_gone"), F.when(~gone, F.col("order_date")).alias("_day"))
        sums = groups.agg(F.max("order_date").alias("order_date"), F.min("first").alias("first"), F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))
        sums.drop("_gone", "_day").repartition("customer_id").write.mode("overwrite").parquet(f"{self.path}/merged/upto={last}")
        done = self.spark.createDataFrame([(last, until)], _MERGES)
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/merges")

    def features(self, as_of: dt.date, inactive_days: int = INACTIVE_DAYS) -> DataFrame:
        """``customer_features`` over all orders received."""
        _, folded = self._last_merge()
        if folded and as_of < folded:
            raise ValueError(f"days before {folded} are folded; features start there")
        return features_from_days(self.days(), as_of, inactive_days, self.lag_days)


def customer_state_stream(orders: DataFrame, state: CustomerState, checkpoint: str):
    """Start a stream that takes all available orders into ``state``."""
    return orders.writeStream.foreachBatch(state.writer()).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
