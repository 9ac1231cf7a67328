import datetime as dt

from pyspark.sql import functions as F

from revenue_lens.operators.weekly import weekly_revenue
from revenue_lens.sources.orders import as_orders


def as_dict(df):
    return {r["week_end"].isoformat(): r["revenue"] for r in df.collect()}


def test_weeks_end_on_monday_and_empty_weeks_are_zero(spark):
    stamps = [("2024-01-01 00:00:00", 1.0), ("2024-01-01 14:00:00", 2.0), ("2024-01-02 00:00:00", 4.0), ("2024-01-20 00:00:00", 8.0)]
    raw = spark.createDataFrame([(1, dt.datetime.fromisoformat(t), v, "A") for t, v in stamps], "customer_id long, order_date timestamp, revenue double, category string")
    weekly = weekly_revenue(as_orders(raw))
    assert as_dict(weekly) == {"2024-01-01": 3.0, "2024-01-08": 4.0, "2024-01-15": 0.0, "2024-01-22": 8.0}


def test_partial_edge_weeks_are_kept_and_flagged(make_orders):
    weekly = weekly_revenue(make_orders([(1, "2024-01-04", 1), (1, "2024-01-09", 2), (1, "2024-01-22", 3)]))
    flags = {r["week_end"].isoformat(): r["is_partial"] for r in weekly.collect()}
    assert flags == {"2024-01-08": True, "2024-01-15": False, "2024-01-22": False}


def test_each_key_has_its_own_range(make_orders):
    orders = make_orders([(1, "2024-01-02", 1), (1, "2024-01-20", 2), (2, "2024-01-09", 5)]).withColumn("k", F.col("customer_id"))
    rows = weekly_revenue(orders, ["k"]).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in rows} == {1: 3, 2: 1}


def test_sum_does_not_depend_on_order_of_rows(make_orders):
    rows = [(i, "2024-01-02", v) for i, v in enumerate([0.1, 0.2, 0.3, 1e9, -1e9 + 0.07])]
    assert as_dict(weekly_revenue(make_orders(rows))) == as_dict(weekly_revenue(make_orders(rows[::-1])))


def test_empty_input(make_orders):
    assert weekly_revenue(make_orders([])).collect() == []


def test_unparsable_text_dates_become_null(spark):
    raw = spark.createDataFrame([(1, "2024-01-02", 1.0, "A"), (2, "never", 2.0, "A")], "customer_id long, order_date string, revenue double, category string")
    assert [r["order_date"] for r in as_orders(raw).orderBy("customer_id").collect()] == [dt.date(2024, 1, 2), None]
