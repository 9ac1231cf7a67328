import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from revenue_lens.functions.tails import chi2_tail
from revenue_lens.operators import alerts, drift


def table(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def brute_psi(b, c):
    edges = np.linspace(min(b.min(), c.min()), max(b.max(), c.max()), 11)
    pb, pc = (np.histogram(v, edges)[0] + 1e-6 for v in (b, c))
    pb, pc = pb / (len(b) + 1e-5), pc / (len(c) + 1e-5)
    return float(((pc - pb) * np.log(pc / pb)).sum())


def brute_ks(b, c):
    points = np.unique(np.concatenate([b, c]))
    f = lambda v: np.searchsorted(np.sort(v), points, side="right") / len(v)
    return float(np.abs(f(b) - f(c)).max())


def test_report_against_brute_force(spark, many_blocks):
    rng = np.random.default_rng(2)
    b, c = rng.normal(size=700).round(2), rng.normal(0.4, 1.2, size=500).round(2)
    row = drift.drift_report(table(spark, b), table(spark, c), ["x"]).first()
    assert row["psi"] == pytest.approx(brute_psi(b, c))
    assert row["ks_stat"] == pytest.approx(brute_ks(b, c))
    assert row["p_value"] < 1e-4


def test_identical_and_constant_samples(spark):
    for values in ([1, 2, 3, 4] * 5, [7] * 20):
        row = drift.drift_report(table(spark, values), table(spark, values), ["x"]).first()
        assert (row["psi"], row["ks_stat"], row["p_value"], row["alert_level"]) == (0.0, 0.0, 1.0, "OK")


def test_levels_are_strict(spark):
    values = [0.05, 0.0500001, 0.15, 0.1500001, 0.25, 0.2500001]
    levels = [r[0] for r in table(spark, values).select(drift.alert_level(F.col("x"))).collect()]
    assert levels == ["OK", "CAUTION", "CAUTION", "WARNING", "WARNING", "CRITICAL"]


def test_unknown_features_are_skipped_and_nothing_is_ok(spark):
    report = drift.drift_report(table(spark, [1, 2]), table(spark, [1, 2]), ["x", "missing"])
    assert [r["feature"] for r in report.collect()] == ["x"]
    summary = drift.drift_summary(report.where("false")).first()
    assert (summary["max_psi"], summary["alert_severity"], summary["features"]) == (0.0, "OK", 0)


def test_summary_takes_the_highest_level(spark):
    report = spark.createDataFrame([("a", 0.06, "CAUTION"), ("b", 0.3, "CRITICAL"), ("c", 0.0, "OK")], "feature string, psi double, alert_level string")
    assert drift.drift_summary(report).first()["alert_severity"] == "CRITICAL"


def test_baseline_stats_against_numpy(spark, many_blocks):
    values = np.concatenate([np.random.default_rng(4).normal(size=301), np.zeros(150)])
    row = drift.baseline_stats(table(spark, values), ["x"]).first()
    assert row["std"] == pytest.approx(values.std(ddof=1))
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_categorical_drift(spark):
    old = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70, "s string")
    new = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, "s string")
    row = drift.categorical_drift(old, new, ["s"]).first()
    assert row["chi2"] == pytest.approx(200 * (30 * 40 - 70 * 60) ** 2 / (90 * 110 * 100 * 100))
    assert row["df"] == 1 and row["p_value"] == pytest.approx(chi2_tail(row["chi2"], 1))
    assert row["alert_level"] == "CRITICAL"


def test_category_seen_on_one_side_only(spark):
    old, new = spark.createDataFrame([("a",)] * 10, "s string"), spark.createDataFrame([("b",)] * 10, "s string")
    row = drift.categorical_drift(old, new, ["s"]).first()
    assert row["chi2"] == pytest.approx(20) and row["psi"] > 1


@pytest.mark.parametrize("df,critical", [(1, 3.841458821), (2, 5.991464547), (3, 7.814727903), (5, 11.07049769), (10, 18.30703805)])
def test_chi_squared_tail(df, critical):
    assert chi2_tail(critical, df) == pytest.approx(0.05, abs=1e-8)


def test_psi_from_moments_is_small_for_a_matching_normal(spark):
    rng = np.random.default_rng(6)
    stats = drift.baseline_stats(table(spark, rng.normal(size=4000)), ["x"])
    near = drift.psi_from_stats(stats, table(spark, rng.normal(size=4000)), ["x"]).first()["psi"]
    far = drift.psi_from_stats(stats, table(spark, rng.normal(1.0, size=4000)), ["x"]).first()["psi"]
    assert near < 0.05 < far


def fired(spark, metric, value, **options):
    metrics = spark.createDataFrame([(metric, float(value))], "metric string, value double")
    return [(r["rule"], r["severity"], r["message"]) for r in alerts.evaluate(metrics, alerts.rules(spark, **options)).collect()]


def test_each_rule(spark):
    assert fired(spark, "churn_rate", 0.36) == [("churn_spike", "WARNING", "Churn rate 36.0% exceeds threshold 35.0% (mean + 3.0σ)")]
    assert fired(spark, "margin", -0.02) == [("margin_decline", "CRITICAL", "Net margin -2.00% below minimum -1.00%")]
    assert fired(spark, "mape", 0.06) == [("forecast_error", "CAUTION", "Forecast MAPE 6.00% exceeds 5.00%")]
    assert fired(spark, "max_psi", 0.16) == [("data_drift", "WARNING", "Data drift PSI 0.160 exceeds 0.150")]
    assert fired(spark, "model_age_days", 31) == [("model_staleness", "CAUTION", "Model last trained 31 days ago (limit: 30)")]


def test_thresholds_are_strict(spark):
    assert fired(spark, "churn_rate", 0.20 + 3 * 0.05) == []
    assert fired(spark, "margin", -0.01) == []
    assert fired(spark, "model_age_days", 30) == []


def test_an_explicit_zero_threshold_counts(spark):
    assert fired(spark, "margin", -0.005) == []
    assert len(fired(spark, "margin", -0.005, thresholds={"margin_decline": 0.0})) == 1


def test_model_age_uses_the_latest_version(spark):
    stamp = lambda d: dt.datetime(2024, 1, d)
    registry = spark.createDataFrame([("m", "v1", stamp(1)), ("m", "v2", stamp(20))], "name string, version string, created_at timestamp")
    age = alerts.model_ages(registry, F.lit("2024-01-25 12:00:00").cast("timestamp")).first()
    assert (age["name"], age["value"]) == ("m", 5.0)


def test_alert_log_appends(spark, tmp_path):
    found = alerts.evaluate(spark.createDataFrame([("mape", 0.5)], "metric string, value double"), alerts.rules(spark))
    for _ in range(2):
        alerts.append_alerts(found, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_exact_p_values_count_all_arrangements(spark):
    from itertools import combinations

    def plain(b, c):
        values = sorted({*b, *c})
        distance = lambda x, y: max(abs(sum(v <= t for v in x) * len(y) - sum(v <= t for v in y) * len(x)) for t in values)
        n, d = len(b), distance(b, c)
        places = list(combinations(range(n + len(c)), n))
        far = 0
        for chosen in places:
            i = j = worst = 0
            for k in range(n + len(c)):
                i, j = (i + 1, j) if k in chosen else (i, j + 1)
                worst = max(worst, abs(i * len(c) - j * n))
            far += worst >= d
        return far / len(places)

    groups = {"apart": ([1, 2, 3, 4], [5, 6, 7, 8, 9]), "mixed": ([1, 4, 6, 9], [2, 3, 5, 7, 8]), "ties": ([1, 1, 2, 5], [1, 2, 2, 7, 7]), "same": ([1, 2, 3], [1, 2, 3]), "one": ([1], [2])}
    rows = [(f, float(v), side) for f, (b, c) in groups.items() for side, part in ((False, b), (True, c)) for v in part]
    found = {r["feature"]: r["p_value"] for r in drift.ks(spark.createDataFrame(rows, "feature string, value double, is_current boolean")).collect()}
    assert found == {f: pytest.approx(plain(*g)) for f, g in groups.items()}
