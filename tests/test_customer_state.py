"""The incremental state against the batch operator over the same orders."""

import datetime as dt
import random

import pytest
from conftest import day
from pyspark.sql import functions as F

from revenue_lens.operators.customers import customer_features
from revenue_lens.streaming import CustomerState, customer_state_stream

LAST = day("2024-06-30")


def orders_of(make_orders, n=600, seed=4):
    r = random.Random(seed)
    rows = [(r.randint(1, 25), str(LAST - dt.timedelta(days=int(r.expovariate(1 / 300)))), r.randint(1, 9999) / 100) for _ in range(n)]
    # Bounds of the windows, repeats and a customer with old orders only.
    rows += [(30, str(LAST - dt.timedelta(days=d)), 5.0) for d in (59, 60, 61, 364, 365, 366, 424, 425, 426, 900)]
    rows += [(31, "2020-01-01", 1.0)] * 3 + [(31, "2020-03-01", 2.0), (32, str(LAST), 7.0)]
    r.shuffle(rows)
    return make_orders(rows).withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(6)))


def same(found, expected):
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    assert key(found) == key(expected)


@pytest.mark.parametrize("merge_after", [(), (0, 1, 2, 3, 4, 5), (2, 5)])
def test_any_split_gives_the_batch_features(spark, tmp_path, make_orders, merge_after):
    orders = orders_of(make_orders).cache()
    state = CustomerState(spark, str(tmp_path))
    for n in range(6):
        state.writer()(orders.where(F.col("part") == n), n)
        if n in merge_after:
            state.merge(LAST - dt.timedelta(days=30 if n < 3 else 0))
    for later in (0, 10, 400):
        at = LAST + dt.timedelta(days=later)
        same(state.features(at), customer_features(orders.drop("part"), at))
    if merge_after:
        folded = state.days().groupBy("customer_id").agg(F.count(F.when(F.col("order_date") <= LAST - dt.timedelta(days=425), 1)).alias("n"))
        if merge_after[-1] == 5:
            assert folded.where("n > 1").count() == 0
        with pytest.raises(ValueError, match="folded"):
            state.features(LAST - dt.timedelta(days=90))


def test_replayed_batches_and_late_orders(spark, tmp_path, make_orders):
    orders = orders_of(make_orders, 80).cache()
    state = CustomerState(spark, str(tmp_path))
    recent, old = orders.where(F.col("order_date") > "2024-01-01"), orders.where(F.col("order_date") <= "2024-01-01")
    state.writer()(recent, 0)
    state.writer()(recent, 0)
    state.merge(LAST)
    state.merge(LAST)
    state.writer()(old, 1)
    same(state.features(LAST), customer_features(orders.drop("part"), LAST))


def test_a_broken_merge_changes_nothing(spark, tmp_path, make_orders, monkeypatch):
    orders = orders_of(make_orders, 50).cache()
    state = CustomerState(spark, str(tmp_path))
    state.writer()(orders, 0)
    monkeypatch.setattr(state, "_last_merge", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.merge(LAST)
    monkeypatch.undo()
    # The merged rows are there, but not the row that makes them count.
    spark.createDataFrame([(1, LAST, LAST, 9, 9)], "customer_id bigint, order_date date, first date, orders bigint, cents bigint").write.parquet(f"{tmp_path}/merged/upto=0")
    same(state.features(LAST), customer_features(orders.drop("part"), LAST))
    state.merge(LAST)
    same(state.features(LAST), customer_features(orders.drop("part"), LAST))


def test_nothing_received(spark, tmp_path):
    state = CustomerState(spark, str(tmp_path))
    state.merge(LAST)
    assert state.features(LAST).collect() == []


def test_stream(spark, tmp_path, make_orders):
    orders = orders_of(make_orders, 120).drop("part").cache()
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    state = CustomerState(spark, str(tmp_path / "state"))
    for n in range(2):  # two runs of the stream, several files each
        orders.where(F.pmod("customer_id", F.lit(2)) == n).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = customer_state_stream(stream, state, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    same(state.features(LAST), customer_features(orders, LAST))
