"""Time the headline queries: ``BENCH_SF_DIR`` (tables) on ``local[BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Nothing
is cached between runs. ``BENCH_PANDAS=1`` adds the time of the same result in
single-threaded pandas where there is a direct counterpart.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

import pandas as pd
from pyspark.sql import SparkSession

from revenue_lens.plans.queries import QUERIES

HEADLINE = [
    "weekly_revenue",
    "weekly_revenue_by_nation",
    "customer_features",
    "customer_features_multi_asof",
    "purchase_gaps",
    "rfm_segments",
    "rfm_segment_profile",
    "top_risk_decile",
    "cohort_retention_long",
    "forecast_metrics",
    "ljung_box",
    "ensemble_inverse_variance",
    "forecast_scenarios",
    "drift_report",
    "monte_carlo_profit",
    "alerts",
    "km_by_segment",
    "ols_profit_drivers",
    "cox_summary",
    "roc_auc",
    "shap_linear",
    "model_scores_fact",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def pandas_runs(sf_dir: str) -> dict:
    """Direct pandas counterparts, reading the same file each time."""

    def orders() -> pd.DataFrame:
        return pd.read_parquet(f"{sf_dir}/orders.parquet", columns=["o_custkey", "o_orderdate", "o_totalprice"])

    def features() -> pd.DataFrame:
        o = orders().sort_values(["o_custkey", "o_orderdate"])
        last = o["o_orderdate"].max()
        parts = []
        for as_of in (last, last - pd.Timedelta(days=60)):
            past = o[o["o_orderdate"] <= as_of]
            recent = past[past["o_orderdate"] > as_of - pd.Timedelta(days=365)]
            gap = past.groupby("o_custkey")["o_orderdate"].diff().dt.days.groupby(past["o_custkey"]).mean()
            by = past.groupby("o_custkey")
            parts.append(
                pd.concat(
                    [by["o_orderdate"].min(), by["o_orderdate"].max(), recent.groupby("o_custkey").size(),
                     recent.groupby("o_custkey")["o_totalprice"].sum(), by["o_totalprice"].sum(), gap],
                    axis=1, keys=["first", "last", "freq", "money", "all", "gap"],
                ).fillna({"freq": 0, "money": 0})
            )
        return parts[0].join(parts[1], rsuffix="_lag")

    def rfm() -> pd.DataFrame:
        f = features()
        for c in ("last", "freq", "money"):
            f[c + "_q"] = pd.cut(f[c].rank(pct=True, method="first"), [0, 0.2, 0.4, 0.6, 0.8, 1.0001], labels=False)
        return f

    def cohorts() -> pd.DataFrame:
        o = orders()
        month = o["o_orderdate"].dt.to_period("M")
        first = month.groupby(o["o_custkey"]).transform("min")
        index = (month.dt.year - first.dt.year) * 12 + month.dt.month - first.dt.month
        return o["o_custkey"].groupby([first, index]).nunique().unstack(fill_value=0)

    return {
        "weekly_revenue": lambda: orders().set_index("o_orderdate")["o_totalprice"].resample("W-MON").sum(),
        "customer_features": features,
        "rfm_segments": rfm,
        "cohort_retention_long": cohorts,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(cpus)
    times = {}
    for name in names:
        run = lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        samples = []
        for _ in range(runs):
            spark.catalog.clearCache()
            samples.append(seconds(run))
        times[name] = round(statistics.median(samples), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_PANDAS"):
        result["pandas"] = {n: round(statistics.median(seconds(r) for _ in range(3)), 3) for n, r in pandas_runs(sf_dir).items()}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
