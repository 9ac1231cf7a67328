import numpy as np
import pytest

from revenue_lens.operators.survival import (
    _log_products,
    _shift_sums,
    cox_model,
    cox_summary,
    kaplan_meier,
    kaplan_meier_by_segment,
    median_survival,
)


def lives(spark, rows):
    return spark.createDataFrame(rows, "duration_days int, event_observed int, rfm_segment string")


GOLDEN = [(5, 1, "a"), (6, 0, "a"), (6, 1, "a"), (8, 1, "a")]


def test_kaplan_meier_golden(spark):
    curve = kaplan_meier(lives(spark, GOLDEN), min_rows=1)
    assert {r["t"]: r["survival"] for r in curve.collect()} == pytest.approx({0: 1.0, 5: 0.75, 6: 0.5, 8: 0.0})
    assert median_survival(curve).first()["median_days"] == 6


def test_too_few_rows_give_no_curve(spark):
    assert kaplan_meier(lives(spark, GOLDEN)).collect() == []


def test_segments_need_ten_rows_and_company(spark):
    rows = [(t, 1, "big") for t in range(1, 13)] + [(t, 0, "mid") for t in range(1, 11)] + [(3, 1, "small")] * 9
    assert {r["segment"] for r in kaplan_meier_by_segment(lives(spark, rows)).collect()} == {"big", "mid"}
    assert kaplan_meier_by_segment(lives(spark, rows[:12])).collect() == []


@pytest.mark.parametrize("d", [1, 2, 16, 17, 100, 5000])
@pytest.mark.parametrize("slack", [0.0, 0.3, 50.0, 1e5])
def test_tie_sums(d, slack):
    a = np.array([d + slack])
    terms = a[0] - np.arange(d)
    assert _shift_sums(a, np.array([float(d)]), 1)[0] == pytest.approx((1 / terms).sum(), rel=1e-9)
    assert _shift_sums(a, np.array([float(d)]), 2)[0] == pytest.approx((1 / terms**2).sum(), rel=1e-8)
    assert _log_products(a, np.array([float(d)]))[0] == pytest.approx(np.log(terms).sum(), rel=1e-9, abs=1e-9)


def sample(seed, n=300, ties=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    time = rng.exponential(np.exp(-(0.8 * x[:, 0] - 0.5 * x[:, 1])))
    censor = rng.exponential(2.0, size=n)
    duration = np.ceil(np.minimum(time, censor) * ties).astype(int).clip(1)
    return x, duration, (time <= censor).astype(int)


def efron(beta, x, t, event, ridge):
    value, gradient = -ridge * beta @ beta / 2, -ridge * beta
    w = np.exp(x @ beta)
    for time in np.unique(t[event == 1]):
        risk, dead = t >= time, (t == time) & (event == 1)
        d = dead.sum()
        value += (x[dead] @ beta).sum()
        gradient = gradient + x[dead].sum(axis=0)
        for j in range(d):
            s0 = w[risk].sum() - j / d * w[dead].sum()
            s1 = (w[risk, None] * x[risk]).sum(axis=0) - j / d * (w[dead, None] * x[dead]).sum(axis=0)
            value -= np.log(s0)
            gradient = gradient - s1 / s0
    return value, gradient


@pytest.mark.parametrize("ties", [1, 40])
def test_cox_solves_the_efron_equations(spark, ties):
    x, t, event = sample(1, ties=ties)
    rows = [(int(a), int(e), float(u), float(v)) for a, e, (u, v) in zip(t, event, x)]
    df = spark.createDataFrame(rows, "duration_days int, event_observed int, u double, v double").repartition(5)
    fit = cox_model(df, ["u", "v"], penalizer=0.01)
    assert fit["status"] == "ok"
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    beta = fit["standardised"]["beta"]
    value, gradient = efron(beta, z, t, event, 0.01 * len(t))
    assert fit["log_likelihood"] == pytest.approx(value, rel=1e-9)
    assert np.abs(gradient).max() < 1e-4
    step = 1e-5
    numeric = [(efron(beta + step * e, z, t, event, 3.0)[1] - efron(beta - step * e, z, t, event, 3.0)[1]) / (2 * step) for e in np.eye(2)]
    assert fit["standardised"]["information"] == pytest.approx(-np.array(numeric), rel=1e-4)
    coef = {r["covariate"]: r["coef"] for r in fit["summary"]}
    assert coef["u"] > 0 > coef["v"]
    assert all(0 <= r["p"] <= 1 for r in fit["ph_test"])


def test_ph_test_sees_a_covariate_that_reverses(spark):
    rng = np.random.default_rng(8)
    group = rng.integers(0, 2, 600)
    # Group 1 fails early or very late, group 0 in between.
    t = np.where(group == 1, np.where(rng.random(600) < 0.5, rng.integers(1, 20, 600), rng.integers(80, 100, 600)), rng.integers(20, 80, 600))
    rows = [(int(a), 1, float(g), float(z)) for a, g, z in zip(t, group, rng.normal(size=600))]
    df = spark.createDataFrame(rows, "duration_days int, event_observed int, g double, noise double")
    p = {r["covariate"]: r["p"] for r in cox_model(df, ["g", "noise"])["ph_test"]}
    assert p["g"] < 1e-3 < p["noise"]


def test_small_sample_is_skipped(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 1.0)] * 20, "duration_days int, event_observed int, u double, v double")
    assert cox_model(df, ["u", "v"])["status"] == "cox_skipped_small_sample"
    assert cox_summary(df, covariates=["u", "v"]).collect() == []
