from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.operators.accuracy import forecast_metrics, holdout_residuals, ljung_box
from revenue_lens.operators.blending import blend, member_weights, with_scenarios
from revenue_lens.operators.forecasting import (
    all_forecasts,
    baseline_forecasts,
    best_model,
    extend_series,
    forecast_comparison,
    split_series,
    weekly_series,
)
from revenue_lens.operators.storage import materialize
from revenue_lens.plans import sql_parts as sql
from revenue_lens.plans.catalog import query, with_ctes
from revenue_lens.settings import EPS
from revenue_lens.sources.orders import orders_by_market_segment, orders_by_nation


def nation_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_series(orders_by_nation(spark, sf_dir), "series_key")


def nation_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_forecasts(split_series(nation_weeks(spark, sf_dir)))


def nation_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members per nation, stored: the fits are the expensive part and feed several steps."""
    return materialize(all_forecasts(materialize(split_series(nation_weeks(spark, sf_dir)))))


SPLIT = """s AS (
  SELECT series_key, week_end, revenue AS y_true, n,
         (row_number() OVER (PARTITION BY series_key ORDER BY week_end) - (n - 26))::INTEGER AS step
  FROM (SELECT *, count(*) OVER (PARTITION BY series_key) AS n FROM w))"""

BASELINES = """b AS (
  SELECT *, lag(y_true, 52) OVER p AS year_ago, lag(y_true) OVER p AS before,
         max(y_true) FILTER (step = 0) OVER (PARTITION BY series_key) AS last,
         max(y_true) FILTER (step = 27 - n) OVER (PARTITION BY series_key) AS first
  FROM s WHERE n > 34 WINDOW p AS (PARTITION BY series_key ORDER BY step)),
fc AS (
  SELECT series_key, 'seasonal_naive' AS model, step, week_end, y_true,
         CASE WHEN step >= 1 THEN coalesce(year_ago, last) ELSE year_ago END AS y_pred FROM b
  UNION ALL
  SELECT series_key, 'drift', step, week_end, y_true,
         CASE WHEN step >= 1 THEN last + step * ((last - first) / (n - 26 - 1)) ELSE before + (last - first) / (n - 26 - 1) END FROM b),
h AS (SELECT * FROM fc WHERE step >= 1)"""

BASE = (sql.NATION_ORDERS, sql.weekly("w", "no", "series_key"), SPLIT, BASELINES)

METRICS = """me AS (
  SELECT series_key, model, avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-9)) AS mape,
         avg(abs(y_true - y_pred) / greatest((abs(y_true) + abs(y_pred)) / 2, 1e-9)) AS smape,
         sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse
  FROM h GROUP BY ALL)"""

INVERSE_VARIANCE = """wt AS (
  SELECT series_key, model, iv / sum(iv) OVER (PARTITION BY series_key) AS weight
  FROM (SELECT series_key, model, 1 / greatest(rmse, 1e-9) ** 2 AS iv FROM me))"""

BLENDED = """bl AS (
  SELECT series_key, step, week_end, any_value(y_true) AS y_true, sum(weight * y_pred) AS y_pred
  FROM h JOIN wt USING (series_key, model) GROUP BY ALL)"""


@query(
    "holdout_split",
    with_ctes(
        *BASE[:3],
        select="SELECT series_key, week_end, y_true, step, CASE WHEN n <= 34 THEN 'too_short' ELSE 'ok' END AS status FROM s",
    ),
)
def q_holdout_split(spark, sf_dir):
    return split_series(nation_weeks(spark, sf_dir))


def _one_model(name: str) -> str:
    return with_ctes(
        *BASE, select=f"SELECT series_key, step, week_end, y_true, round(y_pred, 4) AS y_pred FROM h WHERE model = '{name}'"
    )


def _forecast_rows(spark, sf_dir, model):
    rows = nation_baselines(spark, sf_dir).where((F.col("model") == model) & (F.col("step") >= 1))
    return rows.select("series_key", "step", "week_end", "y_true", F.round("y_pred", 4).alias("y_pred"))


@query("forecast_seasonal_naive", _one_model("seasonal_naive"))
def q_seasonal_naive(spark, sf_dir):
    return _forecast_rows(spark, sf_dir, "seasonal_naive")


@query("forecast_drift", _one_model("drift"))
def q_drift(spark, sf_dir):
    return _forecast_rows(spark, sf_dir, "drift")


@query(
    "forecast_metrics",
    with_ctes(
        sql.SEGMENT_ORDERS, sql.weekly("w", "so", "series_key"), SPLIT, BASELINES, METRICS,
        "z AS (SELECT series_key, model, bool_or(abs(y_true) < 1e-9) AS mape_floored FROM h GROUP BY ALL)",
        select="""SELECT series_key, model, CASE WHEN NOT mape_floored THEN round(mape, 6) END AS mape, mape_floored,
  round(smape, 6) AS smape, round(rmse, 4) AS rmse FROM me JOIN z USING (series_key, model)""",
    ),
)
def q_forecast_metrics(spark, sf_dir):
    """MAPE is NULL, with a flag, where a week without revenue leaves nothing to divide by."""
    weeks = weekly_series(orders_by_market_segment(spark, sf_dir), "series_key")
    forecasts = materialize(baseline_forecasts(split_series(weeks)))
    floored = forecasts.where("step >= 1").groupBy("series_key", "model").agg(F.bool_or(F.abs("y_true") < EPS).alias("mape_floored"))
    m = forecast_metrics(forecasts).join(floored, ["series_key", "model"])
    mape = F.when(~F.col("mape_floored"), F.round("mape", 6)).alias("mape")
    return m.select("series_key", "model", mape, "mape_floored", F.round("smape", 6).alias("smape"), F.round("rmse", 4).alias("rmse"))


@query(
    "best_forecast",
    with_ctes(
        *BASE, METRICS,
        select="""SELECT series_key, model, round(rmse, 4) AS rmse FROM me
  QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY rmse, model) = 1""",
    ),
)
def q_best_forecast(spark, sf_dir):
    return best_model(forecast_metrics(nation_baselines(spark, sf_dir))).withColumn("rmse", F.round("rmse", 4))


@query(
    "holdout_residuals",
    with_ctes(*BASE, select="SELECT series_key, model, step, week_end, round(y_true - y_pred, 4) AS residual FROM h"),
)
def q_holdout_residuals(spark, sf_dir):
    return holdout_residuals(nation_baselines(spark, sf_dir)).withColumn("residual", F.round("residual", 4))


@query(
    "ljung_box",
    with_ctes(
        *BASE,
        """r AS (
  SELECT series_key, model, step, y_true - y_pred - avg(y_true - y_pred) OVER (PARTITION BY series_key, model) AS e
  FROM fc WHERE step <= 0 AND y_true - y_pred IS NOT NULL),
k AS (SELECT unnest(range(1, 11)) AS k),
n AS (SELECT series_key, model, row_number() OVER (PARTITION BY series_key, model ORDER BY step) AS i, e FROM r),
a AS (
  SELECT x.series_key, x.model, k, sum(x.e * y.e) AS s FROM n x CROSS JOIN k
  JOIN n y ON y.series_key = x.series_key AND y.model = x.model AND y.i = x.i - k GROUP BY ALL),
v AS (SELECT series_key, model, count(*) AS n, sum(e * e) AS e0 FROM r GROUP BY ALL),
q AS (
  SELECT series_key, model, any_value(n) AS n, any_value(n) * (any_value(n) + 2) * sum((s / e0) ** 2 / (n - k)) AS q
  FROM a JOIN v USING (series_key, model) GROUP BY ALL),
p AS (SELECT *, exp(-q / 2) * (1 + q / 2 + (q / 2) ** 2 / 2 + (q / 2) ** 3 / 6 + (q / 2) ** 4 / 24) AS p FROM q)""",
        select="SELECT series_key, model, n, round(q, 6) AS lb_stat, round(p, 6) AS lb_p, p > 0.05 AS passes FROM p",
    ),
)
def q_ljung_box(spark, sf_dir):
    return ljung_box(nation_baselines(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("lb_stat", "lb_p")})


BLEND_SELECT = "SELECT series_key, step, week_end, round(y_true, 2) AS y_true, round(y_pred, 4) AS y_pred FROM bl"


def _blended(spark, sf_dir, method):
    # Weights and blend both read the forecasts: keep the weeks, not the orders, below them.
    forecasts = baseline_forecasts(split_series(materialize(nation_weeks(spark, sf_dir))))
    rows = blend(forecasts, member_weights(forecasts, method))
    return rows.select("series_key", "step", "week_end", F.round("y_true", 2).alias("y_true"), F.round("y_pred", 4).alias("y_pred"))


@query(
    "ensemble_equal",
    with_ctes(
        *BASE,
        "wt AS (SELECT series_key, model, 1 / count(*) OVER (PARTITION BY series_key) AS weight FROM (SELECT DISTINCT series_key, model FROM h))",
        BLENDED,
        select=BLEND_SELECT,
    ),
)
def q_ensemble_equal(spark, sf_dir):
    return _blended(spark, sf_dir, "equal")


@query("ensemble_inverse_variance", with_ctes(*BASE, METRICS, INVERSE_VARIANCE, BLENDED, select=BLEND_SELECT))
def q_ensemble_inverse_variance(spark, sf_dir):
    return _blended(spark, sf_dir, "inverse_variance")


STACKING = """mo AS (
  SELECT series_key, var_pop(a) AS vaa, var_pop(b) AS vbb, covar_pop(a, b) AS vab, covar_pop(a, y) AS vay, covar_pop(b, y) AS vby
  FROM (SELECT series_key, step, any_value(y_true) AS y, max(y_pred) FILTER (model = 'drift') AS a,
               max(y_pred) FILTER (model = 'seasonal_naive') AS b FROM h GROUP BY ALL) GROUP BY series_key),
co AS (SELECT series_key,
              CASE WHEN vbb = 0 THEN vay / vaa ELSE (vay * vbb - vby * vab) / (vaa * vbb - vab * vab) END AS ca,
              CASE WHEN vbb = 0 THEN 0 ELSE (vby * vaa - vay * vab) / (vaa * vbb - vab * vab) END AS cb FROM mo)"""


@query(
    "ensemble_stacking_weights",
    with_ctes(
        *BASE, STACKING,
        select="""SELECT series_key, 'drift' AS model, round(ca / (abs(ca) + abs(cb)), 6) AS weight FROM co
  UNION ALL SELECT series_key, 'seasonal_naive', round(cb / (abs(ca) + abs(cb)), 6) FROM co""",
    ),
)
def q_ensemble_stacking_weights(spark, sf_dir):
    weights = member_weights(nation_baselines(spark, sf_dir), "stacking")
    return weights.withColumn("weight", F.round("weight", 6))


FUTURE = """la AS (SELECT series_key, max(week_end) AS last_week, any_value(n) AS n, max_by(y_true, week_end) AS last,
              min_by(y_true, week_end) AS first FROM s GROUP BY series_key HAVING any_value(n) > 8),
st AS (SELECT series_key, last_week, n, last, first, unnest(range(1, 27)) AS step FROM la),
ff AS (
  SELECT st.series_key, 'drift' AS model, step, (last_week + (step * 7)::INTEGER)::DATE AS week_end,
         last + step * ((last - first) / (n - 1)) AS y_pred FROM st
  UNION ALL
  SELECT st.series_key, 'seasonal_naive', st.step, (last_week + (st.step * 7)::INTEGER)::DATE, coalesce(s.y_true, last)
  FROM st LEFT JOIN s ON s.series_key = st.series_key AND s.week_end = last_week + (st.step * 7)::INTEGER - 364),
sc AS (SELECT * FROM (VALUES ('base', 1.0::DOUBLE), ('optimistic', 1 + 0.08::DOUBLE), ('pessimistic', 1 - 0.08::DOUBLE)) t(scenario, factor))"""


@query(
    "forecast_scenarios",
    with_ctes(
        *BASE, METRICS, INVERSE_VARIANCE, FUTURE,
        select="""SELECT series_key, step::INTEGER AS step, week_end, scenario, round(y, 4) AS y_pred, round(y * factor, 4) AS y_scenario
  FROM (SELECT series_key, step, week_end, sum(weight * y_pred) AS y FROM ff JOIN wt USING (series_key, model) GROUP BY ALL)
  CROSS JOIN sc""",
    ),
)
def q_forecast_scenarios(spark, sf_dir):
    """Next 26 weeks: members on the full history, weights from the holdout, three scenarios."""
    weeks = materialize(nation_weeks(spark, sf_dir))
    weights = member_weights(baseline_forecasts(split_series(weeks)))
    future = with_scenarios(blend(baseline_forecasts(extend_series(weeks)), weights))
    return future.select(
        "series_key", "step", "week_end", "scenario",
        F.round("y_pred", 4).alias("y_pred"), F.round("y_scenario", 4).alias("y_scenario"),
    )


@query("forecast_comparison")
def q_forecast_comparison(spark, sf_dir):
    """All members and their inverse-variance blend."""
    forecasts = nation_forecasts(spark, sf_dir)
    blended = blend(forecasts, member_weights(forecasts))
    rows = forecast_comparison(forecasts)
    return rows.unionByName(forecast_metrics(blended), allowMissingColumns=True)


@query("ensemble_stacking")
def q_ensemble_stacking(spark, sf_dir):
    forecasts = nation_forecasts(spark, sf_dir)
    return blend(forecasts, member_weights(forecasts, "stacking"))


@query("forecast_future")
def q_forecast_future(spark, sf_dir):
    """26 weeks ahead from all members refitted on the full history, three scenarios."""
    weeks = materialize(nation_weeks(spark, sf_dir))
    weights = member_weights(materialize(all_forecasts(split_series(weeks))))
    return with_scenarios(blend(materialize(all_forecasts(extend_series(weeks))), weights))
