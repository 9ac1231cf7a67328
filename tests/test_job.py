"""The whole run on a small table, twice: the second run has a drift baseline."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from revenue_lens.operators.churn import Sizes
from revenue_lens.plans.job import run
from revenue_lens.sources.metrics_log import latest_metrics
from revenue_lens.sources.orders import tpch_orders
from revenue_lens.sources.registry import ModelRegistry

SMALL = Sizes(boosting_rounds=3, tuned_rounds=2, forest_trees=5, forest_depth=4, depth_grid=(2, 3), leaves_grid=(2, 3))
TABLES = [
    "churn_calibration", "churn_models", "cluster_rfm_crosstab", "cohort_retention", "cohort_retention_long", "cox_summary",
    "feature_importance", "feature_stats", "forecast_comparison", "forecast_future", "holdout_residuals", "km_by_segment",
    "km_median", "km_overall", "kpi_summary", "segment_profile", "top_drivers",
]


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    orders = tpch_orders(spark, SF_DIR.replace("sf0.01", "sf0.001"), ["o_orderkey"])
    for _ in range(2):
        run(orders, folder, order_key="o_orderkey", sizes=SMALL, n_draws=50, n_orders=200, n_init=1)
    return folder


def csv(spark, out, name):
    return spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/tables/{name}")


def test_every_table_has_rows(spark, out):
    for name in [*TABLES, "drift_report"]:
        assert csv(spark, out, name).count() > 0, name


def test_star_schema(spark, out):
    dim = spark.read.parquet(f"{out}/bi_export/customers_dim.parquet")
    fact = spark.read.parquet(f"{out}/bi_export/model_scores_fact.parquet")
    orders = spark.read.parquet(f"{out}/bi_export/orders_fact.parquet")
    assert dim.count() == fact.count() == orders.select("customer_id").distinct().count()
    assert fact.where("churn_prob IS NULL OR churn_prob NOT BETWEEN 0 AND 1").count() == 0
    assert dim.select("customer_id").distinct().count() == dim.count()


def test_second_run_checks_drift_and_finds_none(spark, out):
    report = csv(spark, out, "drift_report")
    assert report.count() == 6
    assert report.agg(F.max("psi")).first()[0] == pytest.approx(0.0, abs=1e-9)


def test_registry_and_metrics(spark, out):
    registry = ModelRegistry(spark, f"{out}/registry")
    assert registry.list_models() == ["churn_best", "forecast_ensemble"]
    assert len(registry.list_versions("churn_best")) == 2
    assert 0 <= registry.get_metrics("churn_best")["auc_roc"] <= 1
    hashes = {r["dataset_hash"] for r in registry.table().where("name = 'churn_best'").collect()}
    assert len(hashes) == 1 and None not in hashes
    assert registry.load("churn_best").stages
    topics = {r["topic"] for r in latest_metrics(spark, out).select("topic").distinct().collect()}
    assert topics == {"churn", "forecast_comparison", "kmeans", "monte_carlo_orders", "profit_regression", "run", "survival"}


def test_alerts_are_appended(spark, out):
    rules = [r["rule"] for r in spark.read.json(f"{out}/alerts").collect()]
    assert rules.count("churn_spike") == 2
