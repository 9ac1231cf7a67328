import datetime as dt

import pytest
from pyspark.sql import functions as F

from revenue_lens.operators.weekly import weekly_revenue
from revenue_lens.sources.orders import as_orders
from revenue_lens.streaming import drift_alert_writer, score_request_stream, weekly_revenue_stream


@pytest.fixture()
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_stream_weeks_equal_batch_weeks(spark, tmp_path, few_partitions):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=17 * i), float(i)) for i in range(60)]
    # A far later event closes every earlier window.
    rows.append((start + dt.timedelta(days=120), 1.0))
    events = spark.createDataFrame(rows, "ts timestamp_ntz, revenue double")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = (
        weekly_revenue_stream(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    drain(query)
    found = {r["week_end"]: r["revenue"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = weekly_revenue(as_orders(events.select(F.lit(1).alias("customer_id"), F.col("ts").alias("order_date"), "revenue", F.lit("A").alias("category"))))
    last = max(r["week_end"] for r in batch.collect())
    expected = {r["week_end"]: r["revenue"] for r in batch.where("revenue > 0").collect() if r["week_end"] != last}
    assert found == expected


def test_stream_scoring_splits_rejects(spark, tmp_path, few_partitions):
    schema = "customer_id long, recency_days double, frequency_365d double, monetary_365d double, tenure_days double, avg_interpurchase_days double, clv_proxy double"
    spark.createDataFrame([(1, 15.0, 12.0, 2500.0, 400.0, 1.0, 1.0), (0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], schema).write.parquet(str(tmp_path / "in"))
    scored, rejected = score_request_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    for name, frame in (("scored", scored), ("rejected", rejected)):
        drain(
            frame.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp_{name}"))
            .trigger(availableNow=True).start(str(tmp_path / name))
        )
    row = spark.read.parquet(str(tmp_path / "scored")).first()
    assert (row["customer_id"], row["churn_probability"], row["risk_tier"]) == (1, 0.4925, "Medium")
    assert [r["reject_reason"] for r in spark.read.parquet(str(tmp_path / "rejected")).collect()] == ["customer_id < 1"]


def test_drift_alerts_per_batch(spark, tmp_path, few_partitions):
    baseline = spark.range(200).select((F.col("id") % 50).cast("double").alias("recency_days"))
    shifted = spark.range(200).select((F.col("id") % 50 + 40).cast("double").alias("recency_days"))
    shifted.write.parquet(str(tmp_path / "in"))
    query = (
        spark.readStream.schema(shifted.schema).parquet(str(tmp_path / "in")).writeStream
        .foreachBatch(drift_alert_writer(baseline, str(tmp_path / "alerts")))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    drain(query)
    assert [r["rule"] for r in spark.read.json(str(tmp_path / "alerts")).collect()] == ["data_drift"]


def test_drift_from_stored_bins_equals_the_whole_comparison(spark, tmp_path, few_partitions):
    from revenue_lens.operators import drift

    baseline = spark.range(300).select((F.col("id") % 70).cast("double").alias("recency_days"), (F.col("id") % 11).cast("double").alias("frequency_365d"))
    batches = {
        "within": spark.range(120).select((F.col("id") % 30 + 20).cast("double").alias("recency_days"), (F.col("id") % 4).cast("double").alias("frequency_365d")),
        "outside": spark.range(90).select((F.col("id") % 100 - 9).cast("double").alias("recency_days"), (F.col("id") % 11).cast("double").alias("frequency_365d")),
        "one value": spark.range(40).select(F.lit(3.0).alias("recency_days"), F.lit(None).cast("double").alias("frequency_365d")),
    }
    bins = drift.baseline_bins(baseline)
    for current in batches.values():
        psi = lambda df: {r["feature"]: r["psi"] for r in df.collect()}
        want = psi(drift.psi(drift.both_samples(baseline, current)))
        found = psi(drift.psi_from_bins(bins, baseline, current))
        assert found == {f: pytest.approx(want[f]) for f in found} and set(found) >= {"recency_days"}
    # The alerts of a stream, batch by batch, are those of the whole comparison.
    schema = batches["within"].schema
    for name in ("within", "outside"):
        batches[name].coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        stream.writeStream.foreachBatch(drift_alert_writer(baseline, str(tmp_path / "alerts"), thresholds={"data_drift": 0.0}))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    drain(query)
    values = sorted(r["value"] for r in spark.read.json(str(tmp_path / "alerts")).collect())
    assert values == pytest.approx(sorted(drift.drift_summary(drift.psi_report(baseline, batches[n])).first()["max_psi"] for n in ("within", "outside")))
