"""As-of customer features: every snapshot is a set of conditional aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from revenue_lens.functions import from_cents, to_cents
from revenue_lens.functions.calendar import days_between
from revenue_lens.settings import FEATURE_LAG_DAYS, INACTIVE_DAYS, TRAILING_DAYS

LAGGED = ["frequency_365d", "monetary_365d", "tenure_days", "avg_interpurchase_days", "clv_proxy"]

def _sums(as_of: Column, tag: str, orders: str | None = None) -> list[Column]:
    """Algebraic aggregates of one snapshot; all combine on the map side. ``orders``: column with the orders of a row, else one."""
    count = lambda of: F.count(F.when(of, 1)) if orders is None else F.coalesce(F.sum(F.when(of, F.col(orders))), F.lit(0))
    seen = F.col("order_date") <= as_of
    recent = seen & (F.col("order_date") > F.date_sub(as_of, TRAILING_DAYS))
    return [
        F.max(F.when(seen, F.col("order_date"))).alias(f"{tag}_last"),
        count(seen).alias(f"{tag}_orders"),
        count(recent).alias(f"{tag}_recent_orders"),
        F.coalesce(F.sum(F.when(recent, F.col("cents"))), F.lit(0)).alias(f"{tag}_recent_cents"),
        F.coalesce(F.sum(F.when(seen, F.col("cents"))), F.lit(0)).alias(f"{tag}_cents"),
    ]


def _snapshot(as_of: Column, tag: str) -> dict[str, Column]:
    """Feature columns of one snapshot from its sums; NULL where the customer is unknown yet."""
    # Known by then: the first purchase is the same at every later date.
    first, last = F.when(F.col("first") <= as_of, F.col("first")), F.col(f"{tag}_last")
    orders, frequency = F.col(f"{tag}_orders"), F.col(f"{tag}_recent_orders")
    monetary = from_cents(F.col(f"{tag}_recent_cents"))
    recency, tenure = days_between(as_of, last), days_between(last, first)
    # The mean of successive gaps telescopes to tenure / (orders - 1); a single order has none.
    gap = F.when(orders > 1, tenure / (orders - 1)).when(orders == 1, F.lit(0.0))
    return {
        "first_purchase": first,
        "last_purchase": last,
        "frequency_365d": frequency,
        "monetary_365d": monetary,
        "monetary_all": from_cents(F.col(f"{tag}_cents")),
        "recency_days": recency,
        "tenure_days": tenure,
        "avg_interpurchase_days": gap,
        "clv_proxy": monetary * (frequency + 1) / (recency + 1),
    }


def _labelled(as_of: Column, lag_days: int, inactive_days: int) -> dict[str, Column]:
    """Snapshot, churn label, lagged snapshot and survival columns."""
    now, lag = _snapshot(as_of, "now"), _snapshot(F.date_sub(as_of, lag_days), "lag")
    churned = now["recency_days"] > inactive_days
    observed = days_between(as_of, now["first_purchase"])
    until_churn = days_between(F.date_add(now["last_purchase"], inactive_days), now["first_purchase"])
    duration = F.greatest(F.when(churned, until_churn).otherwise(observed), F.lit(1))
    return {
        **now,
        "churned": churned.cast("int"),
        **{f"lag_{c}": F.coalesce(lag[c].cast("double"), F.lit(0.0)) for c in LAGGED},
        "duration_days": duration.cast("int"),
        "event_observed": churned.cast("int"),
    }


def _in_cents(orders: DataFrame, until: dt.date) -> DataFrame:
    return orders.where(F.col("order_date") <= F.lit(until)).select(
        "customer_id", "order_date", to_cents(F.col("revenue")).alias("cents")
    )


def customer_features(
    orders: DataFrame,
    as_of: dt.date,
    inactive_days: int = INACTIVE_DAYS,
    lag_days: int = FEATURE_LAG_DAYS,
) -> DataFrame:
    """One row per customer with an order up to ``as_of``: both snapshots in one aggregation."""
    at = F.lit(as_of)
    sums = _in_cents(orders, as_of).groupBy("customer_id").agg(F.min("order_date").alias("first"), *_sums(at, "now"), *_sums(F.date_sub(at, lag_days), "lag"))
    return sums.select("customer_id", *[c.alias(n) for n, c in _labelled(at, lag_days, inactive_days).items()])


def features_from_days(days: DataFrame, as_of: dt.date, inactive_days: int = INACTIVE_DAYS, lag_days: int = FEATURE_LAG_DAYS) -> DataFrame:
    """`customer_features` from day sums (customer_id, order_date, first, orders, cents). A row may stand for several days that lie
    before every window: ``order_date`` is the last and ``first`` the first of them."""
    at = F.lit(as_of)
    known = days.where(F.col("order_date") <= at)
    sums = known.groupBy("customer_id").agg(F.min("first").alias("first"), *_sums(at, "now", "orders"), *_sums(F.date_sub(at, lag_days), "lag", "orders"))
    return sums.select("customer_id", *[c.alias(n) for n, c in _labelled(at, lag_days, inactive_days).items()])


def customer_features_at(
    orders: DataFrame,
    as_of_dates: list[dt.date],
    inactive_days: int = INACTIVE_DAYS,
    lag_days: int = FEATURE_LAG_DAYS,
) -> DataFrame:
    """`customer_features` at several dates, keyed by (customer_id, as_of_date).

    Orders are summed by customer and day once, and running sums are taken over the days of a customer, which the calendar
    bounds. A snapshot is the difference of running sums: those up to its date and up to the start of its year. Every running
    sum is valid from its day to the day before the next, and only there meets the dates that ask for it, so orders
    are never multiplied by dates; all of it happens behind the shuffle by customer and day sums.
    """
    dates = sorted(set(as_of_dates))
    # What a date looks up: both snapshots' own day, and the last day before their trailing years.
    back = {"now": 0, "now_before": TRAILING_DAYS, "lag": lag_days, "lag_before": lag_days + TRAILING_DAYS}
    asked = [F.struct(F.lit(d).alias("as_of_date"), F.lit(k).alias("kind"), F.lit(d - dt.timedelta(days=n)).alias("at")) for d in dates for k, n in back.items()]
    days = _in_cents(orders, dates[-1]).groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    per_customer = Window.partitionBy("customer_id").orderBy("order_date")
    upto = per_customer.rowsBetween(Window.unboundedPreceding, 0)
    running = days.select(
        "customer_id", "order_date", F.lead("order_date").over(per_customer).alias("_next"), F.min("order_date").over(upto).alias("first"),
        F.sum("n").over(upto).alias("n"), F.sum("cents").over(upto).alias("cents"),
    )
    valid = lambda x: (x["at"] >= F.col("order_date")) & (F.col("_next").isNull() | (x["at"] < F.col("_next")))
    met = running.select("customer_id", "order_date", "first", "n", "cents", F.explode(F.filter(F.array(*asked), valid)).alias("x"))
    of = lambda kind, c: F.max(F.when(F.col("x.kind") == kind, F.col(c)))
    none = F.lit(0).cast("bigint")
    sums = []
    for tag in ("now", "lag"):
        n, cents = F.coalesce(of(tag, "n"), none), F.coalesce(of(tag, "cents"), none)
        sums += [
            of(tag, "order_date").alias(f"{tag}_last"),
            n.alias(f"{tag}_orders"),
            (n - F.coalesce(of(f"{tag}_before", "n"), none)).alias(f"{tag}_recent_orders"),
            (cents - F.coalesce(of(f"{tag}_before", "cents"), none)).alias(f"{tag}_recent_cents"),
            cents.alias(f"{tag}_cents"),
        ]
    at = F.col("as_of_date")
    found = met.groupBy("customer_id", F.col("x.as_of_date").alias("as_of_date")).agg(F.min("first").alias("first"), *sums).where("now_last IS NOT NULL")
    return found.select("customer_id", "as_of_date", *[c.alias(n) for n, c in _labelled(at, lag_days, inactive_days).items()])


def purchase_gaps(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Days since the previous purchase day, one row per (customer, day).

    Orders are first combined by day, so the window over a customer is bounded by the
    calendar however many orders the customer has. The other orders of a day have gap 0.
    """
    if as_of is not None:
        orders = orders.where(F.col("order_date") <= F.lit(as_of))
    days = orders.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("orders"))
    previous = F.lag("order_date").over(Window.partitionBy("customer_id").orderBy("order_date"))
    return days.withColumn("gap_days", days_between(F.col("order_date"), previous))
