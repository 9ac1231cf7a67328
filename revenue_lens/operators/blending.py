"""Weighted combination of the forecasts of one series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.operators.accuracy import MEMBER, error_aggregates
from revenue_lens.settings import EPS

METHODS = ("equal", "inverse_variance", "stacking")
BLEND = "ensemble"

# Share added to the base forecast.
SCENARIOS = {"base": 0.0, "optimistic": 0.08, "pessimistic": -0.08}


def _usable(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c)


def valid_members(forecasts: DataFrame) -> DataFrame:
    """Forecast weeks of the models that predict every one of them."""
    steps = forecasts.where("step >= 1")
    horizon = F.max("step").over(Window.partitionBy("series_key"))
    predicted = F.count(F.when(_usable("y_pred"), 1)).over(Window.partitionBy(*MEMBER))
    return (
        steps.withColumns({"_horizon": horizon, "_predicted": predicted})
        .where("_predicted = _horizon")
        .drop("_horizon", "_predicted")
    )


def _stack(pdf: pd.DataFrame) -> pd.DataFrame:
    """Least squares with intercept on one series (steps x models); intercept dropped."""
    table = pdf.pivot(index="step", columns="model", values="y_pred").sort_index(axis=1)
    truth = pdf.drop_duplicates("step").set_index("step")["y_true"].loc[table.index]
    x = table.to_numpy()
    coef = np.linalg.lstsq(x - x.mean(axis=0), truth.to_numpy() - truth.mean(), rcond=None)[0]
    size = np.abs(coef).sum()
    weight = coef / size if size > 0 else np.full(len(coef), 1.0 / len(coef))
    return pd.DataFrame({"series_key": pdf["series_key"].iloc[0], "model": table.columns, "weight": weight})


def member_weights(forecasts: DataFrame, method: str = "inverse_variance", fit_until: int | None = None) -> DataFrame:
    """(series_key, model, weight) for the valid members of each series.

    By default the weights are fitted on the same holdout they are scored on;
    ``fit_until`` restricts the fit to the first steps, so that the rest stays unseen.
    """
    members = valid_members(forecasts)
    if fit_until is not None:
        members = members.where(F.col("step") <= fit_until)
    series = Window.partitionBy("series_key")
    if method == "equal":
        return members.select(*MEMBER).distinct().withColumn("weight", 1 / F.count(F.lit(1)).over(series))
    if method == "inverse_variance":
        rmse = error_aggregates(F.col("y_true"), F.col("y_pred"))["rmse"]
        inverse = members.groupBy(*MEMBER).agg((1 / F.pow(F.greatest(rmse, F.lit(EPS)), F.lit(2))).alias("inverse"))
        return inverse.select(*MEMBER, (F.col("inverse") / F.sum("inverse").over(series)).alias("weight"))
    if method == "stacking":
        return (
            members.select(*MEMBER, "step", "y_true", "y_pred")
            .groupBy("series_key")
            .applyInPandas(_stack, "series_key string, model string, weight double")
        )
    raise ValueError(f"unknown method {method!r}; choose one of {METHODS}")


def blend(forecasts: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """The weighted sum per step, as rows of model ``ensemble``.

    Without weights all members count equally. The weights of a member that is missing or
    incomplete are not handed to the others.
    """
    if weights is None:
        names = F.size(F.collect_set("model").over(Window.partitionBy("series_key")))
        weighted = valid_members(forecasts.withColumn("weight", 1 / names))
    else:
        weighted = valid_members(forecasts).join(weights, MEMBER, "left")
    share = F.coalesce(F.col("weight"), F.lit(0.0)) * F.col("y_pred")
    return weighted.groupBy("series_key", "step", "week_end").agg(
        F.first("y_true").alias("y_true"), F.sum(share).alias("y_pred"), F.lit(BLEND).alias("model")
    )


def with_scenarios(forecasts: DataFrame, scenarios: dict[str, float] = SCENARIOS) -> DataFrame:
    """One row per forecast row and scenario."""
    cases = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(1 + s).alias("_factor")) for n, s in scenarios.items()])
    return (
        forecasts.select("*", F.inline(cases))
        .withColumn("y_scenario", F.col("y_pred") * F.col("_factor"))
        .drop("_factor")
    )
