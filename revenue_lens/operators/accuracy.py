"""Error metrics and residual checks on long forecast tables.

A forecast table has one row per (series_key, model, step): ``step`` <= 0 are training
weeks with the fitted value, ``step`` >= 1 the forecast weeks. Every window and group is one
series of one model, bounded by the number of weeks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.settings import EPS

MEMBER = ["series_key", "model"]
LJUNG_BOX_LAGS = 10


def _finite(c: Column) -> Column:
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def error_aggregates(y: Column, yhat: Column) -> dict[str, Column]:
    """MAPE, sMAPE (fractions, denominators floored) and RMSE as aggregates."""
    miss = F.abs(y - yhat)
    return {
        "mape": F.avg(miss / F.greatest(F.abs(y), F.lit(EPS))),
        "smape": F.avg(miss / F.greatest((F.abs(y) + F.abs(yhat)) / 2, F.lit(EPS))),
        "rmse": F.sqrt(F.avg(miss * miss)),
    }


def forecast_metrics(forecasts: DataFrame, keys: list[str] = MEMBER) -> DataFrame:
    """Holdout error per series and model; NULL for a model with a missing forecast."""
    holdout = forecasts.where("step >= 1").withColumn("y_pred", _finite(F.col("y_pred")))
    complete = F.count("y_pred") == F.count(F.lit(1))
    errors = error_aggregates(F.col("y_true"), F.col("y_pred"))
    return holdout.groupBy(*keys).agg(*[F.when(complete, e).alias(n) for n, e in errors.items()])


def holdout_residuals(forecasts: DataFrame) -> DataFrame:
    """What the forecast missed, week by week."""
    return forecasts.where("step >= 1").select(*MEMBER, "step", "week_end", (F.col("y_true") - F.col("y_pred")).alias("residual"))


def chi2_tail_even(x: Column, df: int) -> Column:
    """P(X > x) of a chi-squared variable with an even number of degrees of freedom."""
    half = x / 2
    series = sum((F.pow(half, F.lit(j)) / math.factorial(j) for j in range(1, df // 2)), F.lit(1.0))
    return F.exp(-half) * series


def ljung_box(forecasts: DataFrame, lags: int = LJUNG_BOX_LAGS) -> DataFrame:
    """Ljung-Box test of the training residuals at one lag order; NULL below lags + 2 residuals."""
    residuals = (
        forecasts.where("step <= 0")
        .select(*MEMBER, "step", _finite(F.col("y_true") - F.col("y_pred")).alias("r"))
        .where("r IS NOT NULL")
    )
    member = Window.partitionBy(*MEMBER)
    in_order = member.orderBy("step")
    centred = residuals.withColumn("e", F.col("r") - F.avg("r").over(member))
    products = centred.withColumns({f"e{k}": F.col("e") * F.lag("e", k).over(in_order) for k in range(1, lags + 1)})
    sums = products.groupBy(*MEMBER).agg(
        F.count("e").alias("n"),
        F.sum(F.col("e") * F.col("e")).alias("e0"),
        *[F.sum(f"e{k}").alias(f"s{k}") for k in range(1, lags + 1)],
    )
    n = F.col("n")
    rho2 = [F.pow(F.col(f"s{k}") / F.col("e0"), F.lit(2)) / (n - k) for k in range(1, lags + 1)]
    enough = (n >= lags + 2) & (F.col("e0") > 0)
    q = F.when(enough, n * (n + 2) * sum(rho2[1:], rho2[0]))
    return (
        sums.withColumn("lb_stat", q)
        .withColumn("lb_p", chi2_tail_even(F.col("lb_stat"), lags))
        .select(*MEMBER, "n", "lb_stat", "lb_p", (F.col("lb_p") > 0.05).alias("passes"))
    )
