"""Profit drivers: linear regression of log revenue on behaviour."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DRIVERS = ["frequency_365d", "recency_days", "tenure_days"]
OLS_SCHEMA = "term string, coef double, p_value double, r2 double, r2_adj double, aic double, bic double, n bigint"


def profit_drivers(customers: DataFrame) -> DataFrame:
    """log1p(monetary_365d) on frequency, recency and tenure, one row per term.

    The normal-equation solver needs one pass and keeps only the moment matrix.
    """
    target = F.log1p(F.greatest(F.col("monetary_365d"), F.lit(0.0)))
    rows = customers.na.drop(subset=["monetary_365d", *DRIVERS]).withColumn("y", target)
    features = VectorAssembler(inputCols=DRIVERS, outputCol="x").transform(rows)
    model = LinearRegression(featuresCol="x", labelCol="y", solver="normal", regParam=0.0).fit(features)
    fit = model.summary
    n, k = fit.numInstances, len(DRIVERS) + 1
    deviance = n * (math.log(2 * math.pi) + math.log(fit.meanSquaredError) + 1)
    facts = (float(fit.r2), float(fit.r2adj), deviance + 2 * k, deviance + k * math.log(n), n)
    terms = [*zip(DRIVERS, model.coefficients), ("const", model.intercept)]
    table = [(name, float(c), float(p), *facts) for (name, c), p in zip(terms, fit.pValues)]
    return customers.sparkSession.createDataFrame(table, OLS_SCHEMA)
