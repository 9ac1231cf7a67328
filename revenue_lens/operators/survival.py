"""Time to churn: Kaplan-Meier curves and the Cox proportional-hazards model.

Durations are whole days, so after one `groupBy` on the duration every table here is
bounded by the length of the calendar.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.functions.tails import chi2_tail, normal_two_sided
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import BEHAVIOUR_FEATURES

# Smallest samples, ridge penalty.
MIN_KM_ROWS = 40
MIN_SEGMENT_ROWS = 10
MIN_COX_ROWS = 60
PENALIZER = 0.1


def _curve(by_day: DataFrame) -> DataFrame:
    """Survival from (segment, t, n, events) rows, with the start row t = 0, S = 1."""
    segment = Window.partitionBy("segment")
    later = segment.orderBy("t").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = segment.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    day = F.struct("t", "at_risk", "events")
    start = F.struct(F.lit(0).alias("t"), F.col("at_risk"), F.lit(0).cast("bigint").alias("events"))
    is_first = F.lag("t").over(segment.orderBy("t")).isNull()
    days = (
        by_day.withColumns({"at_risk": F.sum("n").over(later), "is_first": is_first})
        .select("segment", F.inline(F.when(F.col("is_first"), F.array(start, day)).otherwise(F.array(day))))
    )
    return days.withColumn("survival", F.product(1 - F.col("events") / F.col("at_risk")).over(so_far))


def _by_day(customers: DataFrame, segment) -> DataFrame:
    known = customers.na.drop(subset=["duration_days", "event_observed"])
    return known.groupBy(segment.alias("segment"), F.col("duration_days").alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("event_observed").cast("bigint")).alias("events")
    )


def kaplan_meier(customers: DataFrame, min_rows: int = MIN_KM_ROWS) -> DataFrame:
    """Curve of all customers (segment ``all``); empty below ``min_rows`` customers."""
    by_day = _by_day(customers, F.lit("all"))
    total = F.sum("n").over(Window.partitionBy("segment"))
    return _curve(by_day.withColumn("_total", total).where(F.col("_total") >= min_rows).drop("_total"))


def kaplan_meier_by_segment(customers: DataFrame, segment: str = "rfm_segment", min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    """One curve per segment of enough customers, provided there is more than one segment."""
    by_day = _by_day(customers, F.col(segment)).where("segment IS NOT NULL")
    total = F.sum("n").over(Window.partitionBy("segment"))
    all_segments = F.size(F.collect_set("segment").over(Window.partitionBy(F.lit(0))))
    kept = by_day.withColumns({"_total": total, "_segments": all_segments})
    return _curve(kept.where((F.col("_total") >= min_rows) & (F.col("_segments") > 1)).drop("_total", "_segments"))


def median_survival(curves: DataFrame) -> DataFrame:
    """First time at which at most half survive; NULL if the curve stays above."""
    return curves.groupBy("segment").agg(F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median_days"))


def _shift_sums(a: np.ndarray, d: np.ndarray, power: int) -> np.ndarray:
    """Sum of (a - l)^-power for l = 0 .. d-1, element-wise.

    Short sums term by term, long ones by the Euler-Maclaurin formula from ``a - d + 16`` on
    (the last 16 terms, where the function bends most, are always added one by one).
    """
    total = np.zeros_like(a)
    tail = np.minimum(d, 16)
    for i in range(16):
        total += np.where(i < tail, np.where(i < tail, a - d + 1 + i, 1.0) ** -power, 0.0)
    long = d > 16
    if long.any():
        low, high = (a - d + 17)[long], a[long]
        antiderivative = np.log(high / low) if power == 1 else 1 / low - 1 / high
        slope = lambda x: -power * x ** (-power - 1)
        third = lambda x: -power * (power + 1) * (power + 2) * x ** (-power - 3)
        total[long] += (
            antiderivative
            + (low**-power + high**-power) / 2
            + (slope(high) - slope(low)) / 12
            - (third(high) - third(low)) / 720
        )
    return total


class _Table:
    """Per-day sums of exp(xb) * {1, x, xx'} over the risk set and over the events."""

    def __init__(self, rows: list, p: int):
        self.t = np.array([r["t"] for r in rows], dtype=float)
        self.d = np.array([r["d"] for r in rows], dtype=float)
        pairs = [(i, j) for i in range(p) for j in range(i, p)]

        def gather(prefix: str):
            s0 = np.array([r[f"{prefix}0"] for r in rows])
            s1 = np.array([[r[f"{prefix}1_{i}"] for i in range(p)] for r in rows])
            s2 = np.zeros((len(rows), p, p))
            for i, j in pairs:
                s2[:, i, j] = s2[:, j, i] = [r[f"{prefix}2_{i}_{j}"] for r in rows]
            return s0, s1, s2

        at_day = gather("a")
        # Rows come in ascending time; everybody with a later or equal duration is at risk.
        self.risk = [np.flip(np.cumsum(np.flip(s, 0), axis=0), 0) for s in at_day]
        self.event = gather("e")
        self.x = np.array([[r[f"x_{i}"] for i in range(p)] for r in rows])


def _day_sums(covariates: DataFrame, beta: np.ndarray) -> DataFrame:
    """One row per distinct duration; partial sums combine on the map side."""
    p = len(beta)
    eta = sum((F.lit(float(b)) * F.col(f"z{i}") for i, b in enumerate(beta)), F.lit(0.0))
    weighted = covariates.withColumn("w", F.exp(eta))
    event = lambda c: F.sum(F.when(F.col("event") == 1, c).otherwise(0.0))
    sums = [F.sum("event").alias("d"), F.sum("w").alias("a0"), event(F.col("w")).alias("e0")]
    for i in range(p):
        sums += [
            F.sum(F.col("w") * F.col(f"z{i}")).alias(f"a1_{i}"),
            event(F.col("w") * F.col(f"z{i}")).alias(f"e1_{i}"),
            event(F.col(f"z{i}")).alias(f"x_{i}"),
        ]
        for j in range(i, p):
            product = F.col("w") * F.col(f"z{i}") * F.col(f"z{j}")
            sums += [F.sum(product).alias(f"a2_{i}_{j}"), event(product).alias(f"e2_{i}_{j}")]
    return weighted.groupBy("t").agg(*sums)


def _efron(table: _Table, beta: np.ndarray):
    """Log-likelihood, gradient, information and the tie-averaged covariate means per day."""
    some = table.d > 0
    d = table.d[some]
    s0, s1, s2 = (s[some] for s in table.risk)
    e0, e1, e2 = (s[some] for s in table.event)
    # The l-th of d tied events sees the risk set less the share l/d of the events.
    a = d * s0 / e0
    r1 = _shift_sums(a, d, 1) * d / e0
    r2 = _shift_sums(a, d, 2) * (d / e0) ** 2
    slope1 = e1 / e0[:, None]
    rest1 = s1 - s0[:, None] * slope1
    mean = d[:, None] * slope1 + rest1 * r1[:, None]
    slope2 = e2 / e0[:, None, None]
    second = d[:, None, None] * slope2 + (s2 - s0[:, None, None] * slope2) * r1[:, None, None]
    cross = np.einsum("ti,tj->tij", slope1, rest1)
    outer = (
        d[:, None, None] * np.einsum("ti,tj->tij", slope1, slope1)
        + (cross + cross.transpose(0, 2, 1)) * r1[:, None, None]
        + np.einsum("ti,tj->tij", rest1, rest1) * r2[:, None, None]
    )
    logs = _log_products(a, d) + d * np.log(e0 / d)
    events_eta = table.x[some] @ beta
    residuals = table.x[some] - mean
    return float((events_eta - logs).sum()), residuals.sum(axis=0), (second - outer).sum(axis=0), table.t[some], d, residuals


def _log_products(a: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Sum of log(a - l) for l = 0 .. d-1, built like `_shift_sums`."""
    total = np.zeros_like(a)
    tail = np.minimum(d, 16)
    for i in range(16):
        total += np.where(i < tail, np.log(np.where(i < tail, a - d + 1 + i, 1.0)), 0.0)
    long = d > 16
    if long.any():
        low, high = (a - d + 17)[long], a[long]
        area = lambda x: x * np.log(x) - x
        total[long] += (
            area(high) - area(low) + (np.log(low) + np.log(high)) / 2
            + (1 / high - 1 / low) / 12 - (2 / high**3 - 2 / low**3) / 720
        )
    return total


def cox_model(
    customers: DataFrame,
    covariates: list[str] | None = None,
    penalizer: float = PENALIZER,
    max_iter: int = 30,
    tolerance: float = 1e-7,
) -> dict:
    """Ridge-penalised Cox fit with Efron ties by Newton steps.

    Each step is one distributed aggregation to the distinct durations; only those rows
    (days times a few sums) reach the driver. Returns ``{"status", "summary", "ph_test"}``
    where the last two are row lists.
    """
    covariates = covariates or BEHAVIOUR_FEATURES
    p = len(covariates)
    complete = customers.select("duration_days", "event_observed", *covariates).na.drop()
    first = complete.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(covariates)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(covariates)],
    ).first()
    n = first["n"]
    if n < MIN_COX_ROWS:
        return {"status": "cox_skipped_small_sample", "summary": [], "ph_test": []}
    means = np.array([first[f"m{i}"] for i in range(p)])
    spreads = np.array([first[f"s{i}"] or 1.0 for i in range(p)])
    standard = materialize(
        complete.select(
            F.col("duration_days").alias("t"),
            F.col("event_observed").cast("bigint").alias("event"),
            *[((F.col(c) - float(means[i])) / float(spreads[i])).alias(f"z{i}") for i, c in enumerate(covariates)],
        )
    )

    def evaluate(beta: np.ndarray):
        table = _Table(sorted(_day_sums(standard, beta).collect(), key=lambda r: r["t"]), p)
        value, gradient, information, *rest = _efron(table, beta)
        ridge = n * penalizer
        return (value - ridge * (beta @ beta) / 2, gradient - ridge * beta, information + ridge * np.eye(p), *rest)

    beta = np.zeros(p)
    current = evaluate(beta)
    if not current[4].size:
        return {"status": "cox_fit_failed: no events", "summary": [], "ph_test": []}
    for _ in range(max_iter):
        step = np.linalg.solve(current[2], current[1])
        if np.abs(step).max() < tolerance:
            break
        for _ in range(10):
            candidate = evaluate(beta + step)
            if np.isfinite(candidate[0]) and candidate[0] >= current[0] - 1e-12 * abs(current[0]):
                break
            step = step / 2
        beta, current = beta + step, candidate
    variance = np.linalg.inv(current[2])
    summary = []
    for i, name in enumerate(covariates):
        coef, se = float(beta[i] / spreads[i]), float(np.sqrt(variance[i, i]) / spreads[i])
        summary.append(
            {
                "covariate": name,
                "coef": coef,
                "exp_coef": float(np.exp(coef)),
                "se": se,
                "coef_lower_95": coef - 1.959963984540054 * se,
                "coef_upper_95": coef + 1.959963984540054 * se,
                "z": coef / se,
                "p": normal_two_sided(coef / se),
            }
        )
    return {
        "status": "ok",
        "log_likelihood": current[0],
        "summary": summary,
        "ph_test": _proportionality(current[4], current[5], variance, covariates),
        "standardised": {"beta": beta, "gradient": current[1], "information": current[2]},
    }


def _proportionality(d: np.ndarray, residuals: np.ndarray, variance: np.ndarray, covariates: list[str]) -> list[dict]:
    """Correlation of scaled Schoenfeld residuals with the (tie-averaged) rank of the event time."""
    events = d.sum()
    rank = np.cumsum(d) - (d - 1) / 2
    centred = rank - (rank * d).sum() / events
    slope = (centred[:, None] * residuals).sum(axis=0) @ variance * events
    rows = []
    for i, name in enumerate(covariates):
        stat = float(slope[i] ** 2 / (events * (d * centred**2).sum() * variance[i, i]))
        rows.append({"covariate": name, "test_statistic": stat, "p": chi2_tail(stat, 1)})
    return rows


COX_SCHEMA = "covariate string, coef double, exp_coef double, se double, coef_lower_95 double, coef_upper_95 double, z double, p double"
PH_SCHEMA = "covariate string, test_statistic double, p double"


def cox_summary(customers: DataFrame, **options) -> DataFrame:
    """Coefficient table; empty when the model was skipped or failed."""
    return customers.sparkSession.createDataFrame(cox_model(customers, **options)["summary"], COX_SCHEMA)


def proportional_hazards_test(customers: DataFrame, **options) -> DataFrame:
    return customers.sparkSession.createDataFrame(cox_model(customers, **options)["ph_test"], PH_SCHEMA)
