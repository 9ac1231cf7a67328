"""Distribution drift between a baseline and a current table of the same features.

Features are stacked to (feature, value) rows and always combined on the map side first:
to ten bins per feature for PSI, to distinct values for KS. The baseline is the whole
baseline table rather than a stored sample of it.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from revenue_lens.functions.tails import chi2_tail
from revenue_lens.operators.ranking import running_totals, values_at_ranks
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import DRIFT_FEATURES

# Fixed values.
BINS = 10
PSI_EPS = 1e-6
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
PSI_LEVELS = [("CRITICAL", 0.25), ("WARNING", 0.15), ("CAUTION", 0.05)]
LEVEL_ORDER = ["OK", "CAUTION", "WARNING", "CRITICAL"]


def stacked(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) rows of the features that ``df`` has; missing values dropped."""
    present = [f for f in features if f in df.columns]
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in present])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))


def both_samples(baseline: DataFrame, current: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """(feature, value, is_current) of the features known to both sides."""
    known = [f for f in features if f in baseline.columns and f in current.columns]
    old = stacked(baseline, known).withColumn("is_current", F.lit(False))
    return old.unionByName(stacked(current, known).withColumn("is_current", F.lit(True)))


def baseline_stats(df: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """Size, mean, sample deviation, range and exact quartiles per feature.

    A quartile lies between two neighbouring ranks; only those rows are searched for.
    """
    values = stacked(df, features)
    position = {name: (lambda n, p=p: (n - 1) * p) for name, p in QUARTILES.items()}
    ends = lambda n: [int(f(n)) + 1 + up for f in position.values() for up in (0, int(f(n)) + 1 < n)]
    found = values_at_ranks(values, "feature", "value", ends)
    moments = values.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = {name: F.lit(None).cast("double") for name in QUARTILES}
    for feature, (n, at) in found.items():
        for i, (name, f) in enumerate(position.items()):
            low, high = at[2 * i], at[2 * i + 1]
            exact = low + (high - low) * (f(n) - int(f(n)))
            quartiles[name] = F.when(F.col("feature") == feature, exact).otherwise(quartiles[name])
    return moments.withColumns(quartiles)


def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, category, n) of categorical columns."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category")) for f in features])
    return df.select(F.inline(cells)).where("category IS NOT NULL").groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))


def _psi_sum(baseline: list[Column], current: list[Column]) -> Column:
    total_b, total_c = sum(baseline[1:], baseline[0]), sum(current[1:], current[0])
    terms = []
    for b, c in zip(baseline, current):
        share_b = (b + PSI_EPS) / (total_b + PSI_EPS * len(baseline))
        share_c = (c + PSI_EPS) / (total_c + PSI_EPS * len(current))
        terms.append((share_c - share_b) * F.log(share_c / share_b))
    return sum(terms[1:], terms[0])


def _bin(value: Column, low: Column, high: Column) -> Column:
    """0-based bin among ``BINS`` of equal width, closed on the left, the last on both sides."""
    step = (high - low) / BINS
    return sum(((value >= low + i * step).cast("int") for i in range(1, BINS)), F.lit(0))


def psi(samples: DataFrame) -> DataFrame:
    """Population stability index per feature over the combined range."""
    ranges = samples.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    # One row per monitored feature, so the broadcast side is bounded by the feature list.
    binned = samples.join(F.broadcast(ranges), "feature").withColumn("bin", _bin(F.col("value"), F.col("low"), F.col("high")))
    by_bin = binned.groupBy("feature", "bin", "is_current").agg(F.count(F.lit(1)).alias("n"))
    # From here on there are at most 2 * BINS rows per feature; an empty bin has no row.
    count = lambda i, side: F.coalesce(F.max(F.when((F.col("bin") == i) & (F.col("is_current") == side), F.col("n"))), F.lit(0))
    counts = by_bin.groupBy("feature").agg(
        *[count(i, False).alias(f"b{i}") for i in range(BINS)], *[count(i, True).alias(f"c{i}") for i in range(BINS)]
    )
    return counts.select(
        "feature", _psi_sum([F.col(f"b{i}") for i in range(BINS)], [F.col(f"c{i}") for i in range(BINS)]).alias("psi")
    )


def baseline_bins(baseline: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """Stored (feature, low, high, b0, ..., b9): what PSI needs of a baseline as long as nothing lies outside its range."""
    values = stacked(baseline, features)
    ranges = values.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    binned = values.join(F.broadcast(ranges), "feature").withColumn("bin", _bin(F.col("value"), F.col("low"), F.col("high")))  # a row per feature
    counts = [F.count(F.when(F.col("bin") == i, 1)).alias(f"b{i}") for i in range(BINS)]
    return materialize(binned.groupBy("feature").agg(F.first("low").alias("low"), F.first("high").alias("high"), *counts))


def psi_from_bins(bins: DataFrame, baseline: DataFrame, current: DataFrame) -> DataFrame:
    """`psi` of a stored ``current`` from ``baseline_bins``. Features within the stored range are compared with the stored counts;
    only for one that leaves it are the baseline's values binned anew, over the range of both."""
    known = [r["feature"] for r in bins.select("feature").collect() if r["feature"] in current.columns]  # the monitored features
    values = stacked(current, known)
    joined = values.join(F.broadcast(bins), "feature")
    outside = F.max((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    number = _bin(F.col("value"), F.col("low"), F.col("high"))
    counts = [F.count(F.when(number == i, 1)).alias(f"c{i}") for i in range(BINS)]
    stored = [F.first(f"b{i}").alias(f"b{i}") for i in range(BINS)]
    table = materialize(joined.groupBy("feature").agg(outside.alias("outside"), *stored, *counts))
    inside = table.where("NOT outside").select("feature", _psi_sum([F.col(f"b{i}") for i in range(BINS)], [F.col(f"c{i}") for i in range(BINS)]).alias("psi"))
    wider = [r["feature"] for r in table.where("outside").select("feature").collect()]
    return inside.unionByName(psi(both_samples(baseline, current, wider))) if wider else inside


def _kolmogorov_tail(x: Column, terms: int = 40) -> Column:
    """Upper tail of the Kolmogorov distribution; 1 where the series has not converged yet."""
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * x * x) for k in range(1, terms + 1)), F.lit(0.0))
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


#: Sizes n * m up to which the p-value counts paths, exactly; above it the large-sample series is used.
EXACT_CELLS = 10_000


def _exact_tail(n: Column, m: Column, distance: Column) -> Column:
    """P(D >= distance) for samples of ``n`` and ``m``: one less the chance that a random path from (0, 0) to (n, m), which takes
    the merged ranks in turn, stays closer to the diagonal than that.

    The chance of being inside up to (i, j) is a mean of those of its two predecessors; one row over j is kept and folded over i.
    """
    bound = F.round(distance * n * m).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def row(above, i):
        def cell(out, j):
            from_above, from_left = F.coalesce(F.get(above, j.cast("int")), F.lit(0.0)), F.coalesce(F.get(out, j.cast("int") - 1), F.lit(0.0))
            share = F.when(i + j == 0, 1.0).otherwise((from_above * i + from_left * j) / (i + j))
            return F.concat(out, F.array(F.when(F.abs(i * m - j * n) < bound, share).otherwise(0.0)))

        return F.aggregate(F.sequence(zero, m), F.array().cast("array<double>"), cell)

    inside = F.aggregate(F.sequence(zero, n), F.array().cast("array<double>"), row)
    return F.greatest(F.lit(0.0), 1.0 - F.element_at(inside, -1))


def ks(samples: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per feature and its p-value: exact for small samples, else for large ones."""
    by_value = samples.groupBy("feature", "value").agg(
        F.count(F.when(~F.col("is_current"), 1)).alias("b"), F.count(F.when(F.col("is_current"), 1)).alias("c")
    )
    totals = running_totals(by_value, "feature", "value", ["b", "c"])
    distance = F.abs(F.col("cum_b") / F.col("all_b") - F.col("cum_c") / F.col("all_c"))
    found = totals.groupBy("feature").agg(F.max(distance).alias("ks_stat"), F.first("all_b").alias("_n"), F.first("all_c").alias("_m"))
    n, m = F.col("_n"), F.col("_m")
    large = _kolmogorov_tail(F.sqrt(n * m / (n + m)) * F.col("ks_stat"))
    p = F.when((n > 0) & (m > 0) & (n * m <= EXACT_CELLS), _exact_tail(n, m, F.col("ks_stat"))).otherwise(large)
    return found.select("feature", "ks_stat", p.alias("p_value"))


def alert_level(value: Column) -> Column:
    level = F.lit(LEVEL_ORDER[0])
    for name, bound in reversed(PSI_LEVELS):
        level = F.when(value > bound, name).otherwise(level)
    return level


def drift_report(baseline: DataFrame, current: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """(feature, test, ks_stat, p_value, psi, alert_level); unknown features are skipped."""
    samples = both_samples(baseline, current, features)
    return (
        ks(samples)
        .join(psi(samples), "feature")
        .withColumns({"test": F.lit("Kolmogorov-Smirnov"), "alert_level": alert_level(F.col("psi"))})
    )


def psi_report(baseline: DataFrame, current: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """(feature, psi, alert_level): what the summary needs of the report, from ten bins per feature."""
    return psi(both_samples(baseline, current, features)).withColumn("alert_level", alert_level(F.col("psi")))


def drift_summary(report: DataFrame) -> DataFrame:
    """Largest PSI and highest level; 0 and OK when nothing was checked."""
    ordinal = F.array_position(F.array(*[F.lit(x) for x in LEVEL_ORDER]), F.col("alert_level"))
    worst = F.coalesce(F.max(ordinal), F.lit(1)).cast("int")
    return report.agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.element_at(F.array(*[F.lit(x) for x in LEVEL_ORDER]), worst).alias("alert_severity"),
        F.count(F.lit(1)).alias("features"),
    )


def categorical_drift(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """PSI over the categories and the chi-squared test of equal shares, per feature."""
    old = value_counts(baseline, features).select("feature", "category", F.col("n").alias("b"), F.lit(0).alias("c"))
    new = value_counts(current, features).select("feature", "category", F.lit(0).alias("b"), F.col("n").alias("c"))
    counts = old.unionByName(new).groupBy("feature", "category").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    # From here on there is one row per category; totals come back by a join on the feature.
    totals = counts.groupBy("feature").agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"), F.count(F.lit(1)).alias("k"))
    share_b = (F.col("b") + PSI_EPS) / (F.col("nb") + PSI_EPS * F.col("k"))
    share_c = (F.col("c") + PSI_EPS) / (F.col("nc") + PSI_EPS * F.col("k"))
    expected = lambda n: (F.col("b") + F.col("c")) * F.col(n) / (F.col("nb") + F.col("nc"))
    cell = lambda o, n: (F.col(o) - expected(n)) * (F.col(o) - expected(n)) / expected(n)
    result = (
        counts.join(totals, "feature")
        .groupBy("feature")
        .agg(
            F.sum((share_c - share_b) * F.log(share_c / share_b)).alias("psi"),
            F.sum(cell("b", "nb") + cell("c", "nc")).alias("chi2"),
            (F.first("k") - 1).alias("df"),
        )
        .withColumns({"test": F.lit("Chi-squared"), "alert_level": alert_level(F.col("psi"))})
    )
    return result.withColumn("p_value", _chi2_tail(F.col("chi2"), F.col("df")))


@F.pandas_udf(DoubleType())
def _chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(a, int(b)) for a, b in zip(x, df)])


def _normal_cdf(z: Column) -> Column:
    """Abramowitz-Stegun 7.1.26, absolute error below 1.5e-7."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    upper = poly * F.exp(-x * x) / 2
    return F.when(z > 0, 1 - upper).otherwise(upper)


def psi_from_stats(stats: DataFrame, current: DataFrame, features: list[str] = DRIFT_FEATURES) -> DataFrame:
    """PSI when only the baseline's moments are kept: expected shares of a normal distribution.

    The bins span the combined range; the outer bins take the tails.
    """
    values = stacked(current, features)
    spans = values.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    ranges = (
        stats.join(spans, "feature")
        .select(
            "feature",
            "n",
            "mean",
            F.greatest("std", F.lit(1e-9)).alias("std"),
            F.least("min", "_lo").alias("low"),
            F.greatest("max", "_hi").alias("high"),
        )
    )
    binned = values.join(F.broadcast(ranges), "feature").withColumn("bin", _bin(F.col("value"), F.col("low"), F.col("high")))
    counts = binned.groupBy("feature", "n", "mean", "std", "low", "high").agg(
        *[F.count(F.when(F.col("bin") == i, 1)).alias(f"c{i}") for i in range(BINS)]
    )
    # From here on there are BINS rows per feature.
    cells = F.array(*[F.struct(F.lit(i).alias("bin"), F.col(f"c{i}").alias("c")) for i in range(BINS)])
    z = lambda i: (F.col("low") + i * (F.col("high") - F.col("low")) / BINS - F.col("mean")) / F.col("std")
    below = F.when(F.col("bin") == 0, 0.0).otherwise(_normal_cdf(F.col("z_low")))
    up_to = F.when(F.col("bin") == BINS - 1, 1.0).otherwise(_normal_cdf(F.col("z_high")))
    total = lambda c: F.sum(c).over(Window.partitionBy("feature")) + PSI_EPS * BINS
    shares = (
        counts.select("feature", "n", "mean", "std", "low", "high", F.inline(cells))
        .withColumns({"z_low": z(F.col("bin")), "z_high": z(F.col("bin") + 1)})
        .withColumn("b", F.col("n") * (up_to - below))
        .withColumns({"share_b": (F.col("b") + PSI_EPS) / total("b"), "share_c": (F.col("c") + PSI_EPS) / total("c")})
    )
    term = (F.col("share_c") - F.col("share_b")) * F.log(F.col("share_c") / F.col("share_b"))
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def save_baseline(baseline: DataFrame, path: str) -> None:
    """Keep the baseline table itself; the statistics follow from it."""
    baseline.write.mode("overwrite").parquet(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def check_against_baseline(spark: SparkSession, path: str, current: DataFrame) -> DataFrame:
    """Report against a saved baseline, stored so that summaries and alerts reuse it."""
    return materialize(drift_report(load_baseline(spark, path), current))
