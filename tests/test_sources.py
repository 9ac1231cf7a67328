import datetime as dt

import pytest
from conftest import day
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from revenue_lens.sources import exports, metrics_log
from revenue_lens.sources.orders import read_orders, split_requests
from revenue_lens.sources.registry import ModelRegistry, dataset_fingerprint, registry_summary


def test_every_format_gives_the_same_orders(spark, make_orders, tmp_path):
    orders = make_orders([(1, "2024-01-02", 1.5), (2, "2024-02-03", 2.25)])
    expected = sorted(map(tuple, orders.collect()))
    for source in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / source)
        writer = orders.write.option("header", True) if source == "csv" else orders.write
        writer.format(source).save(path)
        options = {"inferSchema": "true"} if source == "csv" else {}
        assert sorted(map(tuple, read_orders(spark, path, source, **options).collect())) == expected
    orders.createOrReplaceTempView("orders_view")
    assert sorted(map(tuple, read_orders(spark, "orders_view", "table").collect())) == expected


def test_column_binding(spark, tmp_path):
    spark.createDataFrame([(1, dt.date(2024, 1, 2), 3, "x")], "who int, d date, amount int, kind string").write.parquet(str(tmp_path / "t"))
    orders = read_orders(spark, str(tmp_path / "t"), columns={"customer_id": "who", "order_date": "d", "revenue": "amount", "category": "kind"})
    assert orders.dtypes == [("customer_id", "bigint"), ("order_date", "date"), ("revenue", "double"), ("category", "string")]


def test_request_validation(spark):
    columns = ["customer_id", "recency_days", "frequency_365d", "monetary_365d", "tenure_days", "avg_interpurchase_days", "clv_proxy"]
    rows = [(1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), (2, -1.0, 1.0, 1.0, None, 1.0, 1.0)]
    valid, rejected = split_requests(spark.createDataFrame(rows, columns))
    assert [r["customer_id"] for r in valid.collect()] == [1] and valid.columns == columns
    assert {r["customer_id"]: r["reject_reason"] for r in rejected.collect()} == {0: "customer_id < 1", 2: "recency_days < 0; tenure_days is missing"}


def star(spark, as_of):
    customers = spark.createDataFrame(
        [(1, day("2024-01-01"), day("2024-02-01"), 5, 2, 10.0, 31, "loyal", 0, 0, 1.0, 400, 0)],
        "customer_id long, first_purchase date, last_purchase date, recency_days long, frequency_365d long, monetary_365d double, "
        "tenure_days long, rfm_segment string, kmeans_cluster int, churned int, clv_proxy double, duration_days int, event_observed int",
    )
    scores = spark.createDataFrame([(1, 0.25)], "customer_id long, churn_prob double")
    return exports.customers_dim(customers, as_of), exports.model_scores_fact(customers, scores, as_of, None, 12.5)


def test_star_schema_round_trip_keeps_earlier_snapshots(spark, make_orders, tmp_path):
    out = str(tmp_path)
    orders = exports.orders_fact(make_orders([(1, "2024-01-02", 1.5)]))
    for as_of in (day("2024-02-06"), day("2024-02-07"), day("2024-02-07")):
        dim, scores = star(spark, as_of)
        exports.write_star_schema(dim, orders, scores, out)
    dims = spark.read.parquet(f"{out}/customers_dim.parquet")
    assert sorted(str(r["as_of_date"]) for r in dims.collect()) == ["2024-02-06", "2024-02-07"]
    fact = spark.read.parquet(f"{out}/model_scores_fact.parquet").first()
    assert (fact["churn_prob"], fact["forecast_model_best"], fact["weekly_revenue_last"]) == (0.25, "n/a", 12.5)
    text = spark.read.option("header", True).csv(f"{out}/orders_fact.csv").first()
    assert tuple(text) == ("1", "2024-01-02", "1.5", "A")


def test_metrics_are_overwritten_per_topic(spark, tmp_path):
    root = str(tmp_path)
    metrics_log.write_metrics(metrics_log.metric_rows(spark, {"a": 1, "old": 2}), root, "one")
    metrics_log.write_metrics(metrics_log.metric_rows(spark, {"a": 3.5, "note": "fine"}), root, "one")
    metrics_log.write_metrics(metrics_log.metric_rows(spark, {"b": 4}), root, "two")
    rows = {(r["topic"], r["key"]): (r["value"], r["text"]) for r in metrics_log.latest_metrics(spark, root).collect()}
    assert rows == {("one", "a"): (3.5, None), ("one", "note"): (None, "fine"), ("two", "b"): (4.0, None)}


def test_registry_latest_is_the_highest_version(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    assert registry.list_models() == [] and registry.list_versions("m") == []
    registry.register("m", "20240201_000000", "p2", "t", {"auc": 0.7}, {"depth": 3})
    registry.register("m", "20240101_000000", "p1", "t", {"auc": 0.6})
    assert registry.list_models() == ["m"]
    assert registry.list_versions("m") == ["20240101_000000", "20240201_000000"]
    assert registry.get_metrics("m") == {"auc": 0.7}
    assert registry.get_metrics("m", "20240101_000000") == {"auc": 0.6}
    summary = registry_summary(registry.table()).first()
    assert (summary["total_versions"], summary["latest_version"], summary["latest_metrics"]) == (2, "20240201_000000", {"auc": 0.7})
    for name, version in (("x", "latest"), ("m", "nope")):
        with pytest.raises(ValueError, match="no version"):
            registry.get_metrics(name, version)


def test_models_are_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    registry = ModelRegistry(spark, str(tmp_path))
    versions = [registry.save_model(model, "m", "assembler", metrics={"x": i}) for i in range(2)]
    assert versions[0] < versions[1]
    assert list(registry.load("m").transform(df).first()["v"]) == [1.0, 2.0]
    assert registry.get_metrics("m") == {"x": 1.0}


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "a long, b double")
    assert dataset_fingerprint(df) == dataset_fingerprint(df.repartition(7).select("b", "a"))
    assert dataset_fingerprint(df) != dataset_fingerprint(df.where("a > 0"))
    assert dataset_fingerprint(df) != dataset_fingerprint(df.unionByName(df))
