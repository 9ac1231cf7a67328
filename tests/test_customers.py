import pytest
from conftest import day
from pyspark.sql import functions as F

from revenue_lens.operators.customers import customer_features, customer_features_at, purchase_gaps

AS_OF = day("2024-03-01")
ORDERS = [
    (1, "2023-01-01", 100), (1, "2024-02-01", 50),
    (2, "2023-12-02", 80),
    (3, "2023-12-01", 80),
    (4, "2024-03-01", 10),
    (5, "2024-03-02", 99),
]


@pytest.fixture()
def features(make_orders):
    return {r["customer_id"]: r for r in customer_features(make_orders(ORDERS), AS_OF).collect()}


def test_golden_snapshot(features):
    columns = ["recency_days", "frequency_365d", "monetary_365d", "tenure_days", "avg_interpurchase_days", "clv_proxy", "churned", "duration_days", "event_observed"]
    expected = {
        1: (29, 1, 50, 396, 396, 50 * 2 / 30, 0, 425, 0),
        2: (90, 1, 80, 0, 0, 80 * 2 / 91, 0, 90, 0),
        3: (91, 1, 80, 0, 0, 80 * 2 / 92, 1, 90, 1),
        4: (0, 1, 10, 0, 0, 20, 0, 1, 0),
    }
    assert {k: tuple(r[c] for c in columns) for k, r in features.items()} == expected


def test_orders_after_the_observation_date_are_unseen(features):
    assert 5 not in features


def test_lag_columns_are_zero_for_customers_unknown_then(features):
    columns = ["lag_frequency_365d", "lag_monetary_365d", "lag_clv_proxy"]
    lags = {k: tuple(r[c] for c in columns) for k, r in features.items()}
    # Customer 1's first order is exactly 365 days before the lagged date and falls outside.
    assert lags == {1: (0, 0, 0), 2: (1, 80, 160 / 31), 3: (1, 80, 5.0), 4: (0, 0, 0)}


def test_several_dates_equal_single_dates(make_orders):
    orders = make_orders(ORDERS)
    dates = [day("2024-03-01"), day("2024-01-15"), day("2023-12-01"), day("2023-06-01"), day("2023-01-01"), day("2022-01-01")]
    many = customer_features_at(orders, dates)
    for d in dates:
        one = customer_features(orders, d)
        rows = many.where(F.col("as_of_date") == F.lit(d)).select(one.columns)
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, one.collect()))


def test_mean_gap_equals_mean_of_successive_gaps(make_orders):
    orders = make_orders([(1, "2024-01-01", 1), (1, "2024-01-04", 1), (1, "2024-01-04", 1), (1, "2024-01-15", 1), (2, "2024-01-01", 1)])
    features = {r["customer_id"]: r["avg_interpurchase_days"] for r in customer_features(orders, AS_OF).collect()}
    gaps = purchase_gaps(orders).groupBy("customer_id").agg(F.sum("gap_days").alias("g"), F.sum("orders").alias("n"))
    by_gap = {r["customer_id"]: (r["g"] or 0) / max(r["n"] - 1, 1) for r in gaps.collect()}
    assert features == by_gap == {1: 14 / 3, 2: 0.0}


def test_one_hot_customer_is_combined_before_the_shuffle(spark, make_orders):
    hot = spark.range(30_000).select(
        F.lit(7).cast("long").alias("customer_id"), F.date_add(F.lit(day("2023-06-01")), (F.col("id") % 200).cast("int")).alias("order_date"),
        F.lit(1.0).alias("revenue"), F.lit("A").alias("category"),
    )
    row = customer_features(hot, AS_OF).first()
    assert (row["frequency_365d"], row["monetary_all"]) == (30_000, 30_000.0)
    assert purchase_gaps(hot).count() == 200


def test_empty_input(make_orders):
    assert customer_features(make_orders([]), AS_OF).collect() == []
