"""Forecasts of many weekly series: the series is the unit of parallelism.

Built-in members are window expressions. Fitted members run as grouped maps, one group
per series (per series and candidate order for ARIMA), after the orders have been summed
to weeks, so a group holds at most the weeks of the calendar.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.operators import fits
from revenue_lens.operators.accuracy import MEMBER, forecast_metrics, ljung_box
from revenue_lens.operators.weekly import weekly_revenue
from revenue_lens.settings import HOLDOUT_WEEKS, HORIZON_WEEKS

SEASON = fits.YEAR_WEEKS
MIN_EXTRA_WEEKS = 8
FORECAST_SCHEMA = (
    "series_key string, model string, step int, week_end date, y_true double, y_pred double, "
    "spec string, aic double, bic double, hqic double, status string"
)


def weekly_series(orders: DataFrame, key: str | None = None) -> DataFrame:
    """(series_key, week_end, revenue); one series ``all`` without a key."""
    keyed = orders.withColumn("series_key", F.col(key).cast("string") if key else F.lit("all"))
    return weekly_revenue(keyed, ["series_key"]).select("series_key", "week_end", "revenue")


def split_series(weekly: DataFrame, holdout: int = HOLDOUT_WEEKS) -> DataFrame:
    """Number the weeks: the last ``holdout`` get steps 1.., training ends at step 0.

    A series with no more than ``holdout + 8`` weeks is marked ``too_short``.
    """
    series = Window.partitionBy("series_key")
    weeks = F.count(F.lit(1)).over(series)
    return weekly.select(
        "series_key",
        "week_end",
        F.col("revenue").alias("y_true"),
        (F.row_number().over(series.orderBy("week_end")) - (weeks - holdout)).cast("int").alias("step"),
        F.when(weeks <= holdout + MIN_EXTRA_WEEKS, "too_short").otherwise("ok").alias("status"),
    )


def extend_series(weekly: DataFrame, horizon: int = HORIZON_WEEKS) -> DataFrame:
    """The whole history as training weeks, followed by ``horizon`` future weeks."""
    history = split_series(weekly, 0)
    future = (
        history.groupBy("series_key", "status")
        .agg(F.max("week_end").alias("last"))
        .select("series_key", "status", "last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
        .select(
            "series_key",
            F.date_add("last", F.col("step") * 7).alias("week_end"),
            F.lit(None).cast("double").alias("y_true"),
            "step",
            "status",
        )
    )
    return history.unionByName(future)


def baseline_forecasts(split: DataFrame) -> DataFrame:
    """Seasonal naive (the week one year before) and drift, as window expressions.

    Forecast weeks look back one season, so the horizon must not exceed it. Without a
    week one year back, the last training value stands in.
    """
    series = Window.partitionBy("series_key")
    train = F.when(F.col("step") <= 0, F.col("y_true"))
    last = F.max(F.when(F.col("step") == 0, F.col("y_true"))).over(series)
    first = F.max(F.when(F.col("_n") == 1, F.col("y_true"))).over(series)
    size = F.count(train).over(series)
    slope = (last - first) / F.nullif(size - 1, F.lit(0))
    before = F.lag("y_true", 1).over(series.orderBy("step"))
    year_ago = F.lag("y_true", SEASON).over(series.orderBy("step"))
    ahead = F.col("step") >= 1
    members = {
        "seasonal_naive": F.when(ahead, F.coalesce(year_ago, last)).otherwise(year_ago),
        "drift": F.when(ahead, last + F.col("step") * slope).otherwise(before + slope),
    }
    numbered = split.where("status = 'ok'").withColumn("_n", F.row_number().over(series.orderBy("step")))
    return numbered.withColumns(members).select(
        "series_key",
        "step",
        "week_end",
        "y_true",
        F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("y_pred")) for m in members])),
    )


def _run(pdf: pd.DataFrame, model: str, spec: str, fit) -> pd.DataFrame:
    """Fit one group; a failure becomes a status row with empty forecasts."""
    pdf = pdf.sort_values("step")
    train = pdf.loc[pdf["step"] <= 0, "y_true"].to_numpy(dtype=float)
    out = pdf[["series_key", "step", "week_end", "y_true"]].assign(model=model, spec=spec, y_pred=np.nan)
    aic = bic = hqic = None
    try:
        if pdf["status"].iloc[0] != "ok":
            raise ValueError(pdf["status"].iloc[0])
        result = fit(train, len(pdf) - len(train), list(pdf["week_end"]))
        out["y_pred"] = np.concatenate([result.fitted, result.forecast])
        aic, bic, hqic = fits.information_criteria(train, result)
        status = "ok"
    except (ValueError, np.linalg.LinAlgError) as problem:
        status = str(problem)
    return out.assign(aic=aic, bic=bic, hqic=hqic, status=status)


def holt_winters_forecasts(split: DataFrame) -> DataFrame:
    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return _run(pdf, "holt_winters", "additive", lambda y, h, _: fits.holt_winters(y, h))

    return split.groupBy("series_key").applyInPandas(fit_group, FORECAST_SCHEMA)


def arima_forecasts(split: DataFrame) -> DataFrame:
    """All candidate orders in parallel; the lowest BIC per series wins. Where every candidate fails, (0, 1, 1) without a season is
    fitted to its steps, which any two values allow."""
    grid = [(o, s) for o in fits.ARIMA_ORDERS for s in fits.SEASONAL_CHOICES]

    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        number = pdf["candidate"].iloc[0]
        if number == len(grid):
            return _run(pdf, "sarima", "(0, 1, 1) fallback", lambda y, h, _: fits.moving_average_of_steps(y, h))
        order, seasonal = grid[number]
        return _run(pdf, "sarima", f"{order}x{seasonal}", lambda y, h, _: fits.arima(y, h, order, seasonal))

    candidates = split.withColumn("candidate", F.explode(F.array(*[F.lit(i) for i in range(len(grid) + 1)])))
    tried = candidates.groupBy("series_key", "candidate").applyInPandas(fit_group, FORECAST_SCHEMA)
    rank = F.struct(F.col("status") != "ok", F.col("spec").endswith("fallback"), F.coalesce("bic", F.lit(float("inf"))), "spec")
    best = F.min(rank).over(Window.partitionBy("series_key"))
    return tried.withColumn("_best", best).where("_best.spec = spec").drop("_best")


def fourier_trend_forecasts(split: DataFrame, extra_holidays: list[dt.date] | None = None) -> DataFrame:
    """US holidays plus optional own dates enter as indicator weeks."""
    extra = list(extra_holidays or [])

    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        years = range(pdf["week_end"].min().year - 1, pdf["week_end"].max().year + 1)
        holidays: dict[str, list[dt.date]] = {"custom": extra} if extra else {}
        for year in years:
            for name, day in fits.us_holidays(year).items():
                holidays.setdefault(name, []).append(day)
        return _run(pdf, "fourier_trend", "us_holidays", lambda y, h, weeks: fits.fourier_trend(y, h, weeks, holidays))

    return split.groupBy("series_key").applyInPandas(fit_group, FORECAST_SCHEMA)


def all_forecasts(split: DataFrame, extra_holidays: list[dt.date] | None = None) -> DataFrame:
    """Every member in one long table."""
    fitted = holt_winters_forecasts(split).unionByName(arima_forecasts(split))
    fitted = fitted.unionByName(fourier_trend_forecasts(split, extra_holidays))
    baselines = baseline_forecasts(split).withColumns({"spec": F.lit(None).cast("string"), "status": F.lit("ok")})
    return fitted.unionByName(baselines, allowMissingColumns=True)


def forecast_comparison(forecasts: DataFrame) -> DataFrame:
    """One row per series and model: errors, information criteria, Ljung-Box p, status."""
    facts = forecasts.groupBy(*MEMBER).agg(
        *[F.first(c).alias(c) for c in ("spec", "aic", "bic", "hqic", "status")],
        F.stddev_pop(F.when(F.col("step") <= 0, F.nanvl(F.col("y_true") - F.col("y_pred"), F.lit(None)))).alias("residual_std"),
    )
    tests = ljung_box(forecasts).select(*MEMBER, F.col("lb_p").alias("ljung_box_p"))
    return facts.join(forecast_metrics(forecasts), MEMBER, "left").join(tests, MEMBER, "left")


def best_model(comparison: DataFrame) -> DataFrame:
    """Lowest finite RMSE per series, ties by model name."""
    usable = comparison.where(F.col("rmse").isNotNull() & ~F.isnan("rmse") & (F.col("rmse") < float("inf")))
    return usable.groupBy("series_key").agg(
        F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse")
    )
