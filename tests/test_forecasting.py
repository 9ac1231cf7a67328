import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revenue_lens.operators import fits
from revenue_lens.operators.accuracy import chi2_tail_even, forecast_metrics, ljung_box
from revenue_lens.operators.blending import blend, member_weights, with_scenarios
from revenue_lens.operators.forecasting import (
    all_forecasts,
    baseline_forecasts,
    best_model,
    extend_series,
    forecast_comparison,
    split_series,
)

FORECASTS = "series_key string, model string, step int, week_end date, y_true double, y_pred double"


def rows_of(spark, members, truth, start_step=1):
    monday = dt.date(2024, 1, 1)
    rows = [
        ("s", m, start_step + i, monday + dt.timedelta(weeks=i), float(y), None if p is None else float(p))
        for m, predictions in members.items()
        for i, (y, p) in enumerate(zip(truth, predictions))
    ]
    return spark.createDataFrame(rows, FORECASTS)


def weekly(spark, n, key="s", value=lambda t: 1000 + 5 * t + 200 * math.sin(2 * math.pi * t / 52)):
    monday = dt.date(2018, 1, 1)
    return spark.createDataFrame([(key, monday + dt.timedelta(weeks=t), float(value(t))) for t in range(n)], "series_key string, week_end date, revenue double")


def test_error_metrics(spark):
    m = forecast_metrics(rows_of(spark, {"a": [110, 180]}, [100, 200])).first()
    assert m["mape"] == pytest.approx(0.1)
    assert m["smape"] == pytest.approx((10 / 105 + 20 / 190) / 2)
    assert m["rmse"] == pytest.approx(math.sqrt(250))
    assert forecast_metrics(rows_of(spark, {"a": [1]}, [0])).first()["mape"] == pytest.approx(1e9)


def test_metrics_of_an_incomplete_model_are_null(spark):
    m = forecast_metrics(rows_of(spark, {"a": [110, None], "b": [110, float("nan")]}, [100, 200])).collect()
    assert [r["rmse"] for r in m] == [None, None]


def test_split_and_too_short_series(spark):
    split = split_series(weekly(spark, 60).unionByName(weekly(spark, 34, "short"))).collect()
    long = [r for r in split if r["series_key"] == "s"]
    assert sorted(r["step"] for r in long) == list(range(-33, 27))
    assert {r["status"] for r in long} == {"ok"}
    assert {r["status"] for r in split if r["series_key"] == "short"} == {"too_short"}
    assert {r["series_key"] for r in baseline_forecasts(split_series(weekly(spark, 34, "short"))).collect()} == set()


def test_seasons_follow_the_length():
    assert [(fits.smoothing_season(n), fits.arima_season(n)) for n in (20, 104, 319)] == [(10, 6), (52, 34), (52, 52)]


def test_ljung_box_matches_direct_computation(spark):
    noise = np.random.default_rng(3).normal(size=100)
    row = ljung_box(rows_of(spark, {"a": np.zeros(100)}, noise, start_step=-99)).first()
    e = noise - noise.mean()
    q = 100 * 102 * sum((e[k:] @ e[:-k] / (e @ e)) ** 2 / (100 - k) for k in range(1, 11))
    assert row["lb_stat"] == pytest.approx(q)
    assert row["passes"] and row["lb_p"] > 0.05


def test_ljung_box_needs_twelve_residuals(spark):
    row = ljung_box(rows_of(spark, {"a": [0, 0, 0]}, [1, 2, 3], start_step=-2)).first()
    assert (row["lb_stat"], row["lb_p"], row["passes"]) == (None, None, None)


def test_even_chi_squared_tail(spark):
    # 5 % critical values of the chi-squared distribution with 2 and 10 degrees of freedom.
    row = spark.range(1).select(chi2_tail_even(F.lit(5.991464547), 2).alias("a"), chi2_tail_even(F.lit(18.30703805), 10).alias("b")).first()
    assert row["a"] == pytest.approx(0.05, abs=1e-9) and row["b"] == pytest.approx(0.05, abs=1e-9)


def test_blend_golden(spark):
    forecasts = rows_of(spark, {"A": [11, 21], "B": [12, 22]}, [10, 20])
    weights = {r["model"]: r["weight"] for r in member_weights(forecasts).collect()}
    assert weights == pytest.approx({"A": 0.8, "B": 0.2})
    combined = blend(forecasts, member_weights(forecasts)).orderBy("step").collect()
    assert [r["y_pred"] for r in combined] == pytest.approx([11.2, 21.2])
    equal = blend(forecasts, member_weights(forecasts, "equal")).orderBy("step").collect()
    assert [r["y_pred"] for r in equal] == pytest.approx([11.5, 21.5])
    assert [r["y_pred"] for r in blend(forecasts).orderBy("step").collect()] == pytest.approx([11.5, 21.5])


def test_member_with_a_gap_is_dropped_but_weight_is_not_redistributed(spark):
    truth = [10, 20]
    weights = member_weights(rows_of(spark, {"A": [11, 21], "B": [12, 22]}, truth))
    gap = rows_of(spark, {"A": [11, 21], "B": [12, None]}, truth)
    assert {r["model"] for r in member_weights(gap).collect()} == {"A"}
    assert [r["y_pred"] for r in blend(gap, weights).orderBy("step").collect()] == pytest.approx([8.8, 16.8])


def test_stacking_drops_the_intercept_and_allows_negative_weights(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=20), rng.normal(size=20)
    truth = 100 + 3 * a - 1 * b
    weights = {r["model"]: r["weight"] for r in member_weights(rows_of(spark, {"A": a, "B": b}, truth), "stacking").collect()}
    assert weights == pytest.approx({"A": 0.75, "B": -0.25})


def test_weights_can_be_fitted_on_the_first_steps_only(spark):
    forecasts = rows_of(spark, {"A": [10, 99], "B": [11, 20]}, [10, 20])
    all_steps = {r["model"]: r["weight"] for r in member_weights(forecasts).collect()}
    first_only = {r["model"]: r["weight"] for r in member_weights(forecasts, fit_until=1).collect()}
    assert all_steps["B"] > 0.9 and first_only["A"] > 0.9


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="unknown method"):
        member_weights(rows_of(spark, {"A": [1]}, [1]), "median")


def test_scenarios(spark):
    rows = with_scenarios(rows_of(spark, {"A": [100]}, [0])).collect()
    assert {r["scenario"]: r["y_scenario"] for r in rows} == pytest.approx({"base": 100, "optimistic": 108, "pessimistic": 92})


def test_baselines(spark):
    rows = baseline_forecasts(split_series(weekly(spark, 160, value=lambda t: 10.0 * t))).where("step >= 1").collect()
    drift = {r["step"]: r["y_pred"] for r in rows if r["model"] == "drift"}
    naive = {r["step"]: r["y_pred"] for r in rows if r["model"] == "seasonal_naive"}
    assert drift[5] == pytest.approx(10 * (133 + 5))
    assert naive[5] == pytest.approx(10 * (133 + 5 - 52))


def test_every_member_predicts_a_seasonal_trend(spark):
    noise = np.random.default_rng(1).normal(scale=20, size=220)
    series = weekly(spark, 220, value=lambda t: 1000 + 5 * t + 200 * math.sin(2 * math.pi * t / 52) + noise[t])
    forecasts = all_forecasts(split_series(series))
    table = {r["model"]: r for r in forecast_comparison(forecasts).collect()}
    assert set(table) == {"holt_winters", "sarima", "fourier_trend", "seasonal_naive", "drift"}
    assert all(r["status"] == "ok" for r in table.values())
    assert all(table[m]["mape"] < 0.05 for m in ("holt_winters", "sarima", "fourier_trend"))
    assert table["sarima"]["bic"] > table["sarima"]["aic"]
    assert table["drift"]["aic"] is None
    best = best_model(forecast_comparison(forecasts)).first()
    assert best["rmse"] == min(r["rmse"] for r in table.values())


def test_failed_fits_become_status_rows(spark):
    forecasts = all_forecasts(split_series(weekly(spark, 40)))
    table = {r["model"]: r for r in forecast_comparison(forecasts).collect()}
    # No order of the grid fits so short a series; the steps alone are left.
    assert table["sarima"]["spec"] == "(0, 1, 1) fallback" and table["sarima"]["status"] == "ok" and table["sarima"]["rmse"] > 0
    assert table["holt_winters"]["status"] == "ok"
    nothing = all_forecasts(split_series(weekly(spark, 3))).where("model = 'sarima'").select("spec", "status").distinct().collect()
    assert all(r["status"] != "ok" for r in nothing)


def test_the_fallback_recovers_its_weight():
    rng = np.random.default_rng(3)
    shocks = rng.normal(size=4000)
    y = 50 + np.concatenate([[0], np.cumsum(shocks[1:] - 0.6 * shocks[:-1])])
    fit = fits.moving_average_of_steps(y, 3)
    # With weight -0.6 the forecast is simple smoothing at rate 0.4, and one-step errors have the variance of the shocks.
    level = y[0]
    for value in y[1:]:
        level += 0.4 * (value - level)
    assert np.var(y[1:] - fit.fitted[1:]) == pytest.approx(1.0, abs=0.06)
    assert fit.forecast == pytest.approx([level] * 3, abs=0.2)
    with pytest.raises(ValueError):
        fits.moving_average_of_steps(y[:1], 3)


def test_future_weeks_follow_the_history(spark):
    future = extend_series(weekly(spark, 60)).where("step >= 1").orderBy("step").collect()
    assert [r["step"] for r in future] == list(range(1, 27))
    assert future[0]["week_end"] == dt.date(2018, 1, 1) + dt.timedelta(weeks=60)
    assert {r["y_true"] for r in future} == {None}


def test_holt_winters_recovers_a_pure_season():
    t = np.arange(120)
    fit = fits.holt_winters(100 + np.sin(2 * np.pi * t / 52) * 10, 10)
    expected = 100 + np.sin(2 * np.pi * np.arange(120, 130) / 52) * 10
    assert np.abs(fit.forecast - expected).max() < 2


def test_arima_recovers_an_autoregression():
    rng = np.random.default_rng(5)
    y = np.zeros(400)
    for t in range(1, 400):
        y[t] = 20 + 0.8 * (y[t - 1] - 20) + rng.normal()
    fit = fits.arima(y, 3, (1, 0, 1), (0, 0))
    residual = (y - fit.fitted)[np.isfinite(fit.fitted)]
    assert 0.8 < residual.std() < 1.2
    assert abs(fit.forecast[0] - (20 + 0.8 * (y[-1] - 20))) < 0.6


def test_holidays():
    days = fits.us_holidays(2024)
    assert days["thanksgiving"] == dt.date(2024, 11, 28) and days["memorial"] == dt.date(2024, 5, 27) and days["king"] == dt.date(2024, 1, 15)


def test_fourier_trend_learns_a_holiday():
    weeks = [dt.date(2018, 1, 1) + dt.timedelta(weeks=t) for t in range(230)]
    special = [dt.date(y, 3, 14) for y in range(2018, 2023)]
    mark = np.array([any(0 <= (w - d).days < 7 for d in special) for w in weeks], dtype=float)
    y = 100 + 50 * mark
    fit = fits.fourier_trend(y[:200], 30, weeks, {"custom": special})
    assert np.abs(fit.forecast - y[200:]).max() < 5


def test_fits_run_where_the_package_is_not_installed(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "fit.bin").write_bytes(cloudpickle.dumps(lambda: fits.holt_winters(np.arange(30.0), 2).forecast.shape))
    code = "import pickle, sys; print(pickle.load(open(sys.argv[1], 'rb'))(), 'revenue_lens' in sys.modules)"
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "fit.bin")], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=60)
    assert out.stdout.split() == ["(2,)", "False"], out.stderr
