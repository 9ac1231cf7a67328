"""The whole run: orders in, result tables out."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators import alerts, attribution, churn, drift, segments, survival
from revenue_lens.operators.accuracy import forecast_metrics, holdout_residuals
from revenue_lens.operators.blending import BLEND, blend, member_weights, with_scenarios
from revenue_lens.operators.cohorts import COHORTS, PERIODS, cohort_retention, cohort_retention_table
from revenue_lens.operators.customers import customer_features
from revenue_lens.operators.forecasting import all_forecasts, best_model, extend_series, forecast_comparison, split_series, weekly_series
from revenue_lens.operators.ranking_metrics import calibration
from revenue_lens.operators.regression import profit_drivers
from revenue_lens.operators.rfm import add_rfm_segments, segment_profile
from revenue_lens.operators.simulation import DEFAULT_DRAWS, monte_carlo_profit
from revenue_lens.operators.storage import materialize
from revenue_lens.plans.model_queries import kpi_table
from revenue_lens.settings import CHURN_FEATURES, FEATURE_LAG_DAYS, HOLDOUT_WEEKS, HORIZON_WEEKS, SEED
from revenue_lens.sources import exports, metrics_log
from revenue_lens.sources.orders import latest_order_date
from revenue_lens.sources.registry import ModelRegistry, dataset_fingerprint, new_version


def run(
    orders: DataFrame,
    out_dir: str,
    as_of: dt.date | None = None,
    order_key: str | None = None,
    baseline: DataFrame | None = None,
    sizes: churn.Sizes = churn.Sizes(),
    n_draws: int = DEFAULT_DRAWS,
    n_orders: int | None = None,
    n_init: int = 10,
    seed: int = SEED,
) -> None:
    """Run every operator on ``orders`` and write all tables under ``out_dir``.

    The customer table and the weekly series are written once and feed everything below
    them. ``baseline`` is an earlier customer table for the drift check; without it the one
    saved by the previous run is used, and the first run only saves it. ``order_key`` names a
    unique order column that seeds the simulated draws; without one the orders are numbered once
    and stored, so that equal orders draw independently.
    """
    spark = orders.sparkSession
    as_of = as_of or latest_order_date(orders)
    tables, registry = f"{out_dir}/tables", ModelRegistry(spark, f"{out_dir}/registry")
    metric_tables: list[DataFrame] = []

    # Weekly series, forecasts, ensemble.
    weekly = materialize(weekly_series(orders))
    forecasts = materialize(all_forecasts(split_series(weekly)))
    weights = materialize(member_weights(forecasts))
    blended = materialize(blend(forecasts, weights))
    blend_metrics = materialize(forecast_metrics(blended))
    comparison = materialize(forecast_comparison(forecasts).unionByName(blend_metrics, allowMissingColumns=True))
    future = with_scenarios(blend(materialize(all_forecasts(extend_series(weekly, HORIZON_WEEKS))), weights))
    exports.write_csv(comparison, f"{tables}/forecast_comparison")
    exports.write_csv(holdout_residuals(forecasts.unionByName(blended, allowMissingColumns=True)), f"{tables}/holdout_residuals")
    exports.write_csv(future.select("series_key", "step", "week_end", "scenario", "y_scenario"), f"{tables}/forecast_future")
    metrics_log.write_metrics(comparison, out_dir, "forecast_comparison")
    # One series and a handful of members.
    facts = {r["model"]: r["weight"] for r in weights.collect()}
    errors = next(iter(blend_metrics.collect()), None)
    if errors is not None:
        values = {k: errors[k] for k in ("mape", "smape", "rmse") if errors[k] is not None}
        registry.register("forecast_ensemble", new_version(), None, BLEND, values, facts)
        metric_tables.append(alerts.metric_row(blend_metrics, "mape", "mape"))

    # Customers, RFM, clusters.
    features = materialize(customer_features(orders, as_of))
    ranked = materialize(add_rfm_segments(features))
    clustered, meta = segments.kmeans_segmentation(ranked, seed=seed, n_init=n_init)
    customers = materialize(clustered)
    exports.write_csv(segments.cluster_segment_crosstab(customers), f"{tables}/cluster_rfm_crosstab")
    exports.write_csv(segment_profile(customers), f"{tables}/segment_profile")
    scores_by_k = {f"silhouette_k{k}": s for k, s in meta["silhouette_by_k"].items()}
    metrics_log.write_metrics(metrics_log.metric_rows(spark, {"best_k": meta["best_k"], **scores_by_k}), out_dir, "kmeans")

    # Drift against the previous customer table.
    baseline_path = f"{out_dir}/monitoring/baseline"
    if baseline is None:
        try:
            baseline = drift.load_baseline(spark, baseline_path)
        except AnalysisException:  # first run
            drift.save_baseline(features, baseline_path)
    if baseline is not None:
        report = materialize(drift.drift_report(baseline, customers))
        exports.write_csv(report, f"{tables}/drift_report")
        metric_tables.append(alerts.metric_row(drift.drift_summary(report), "max_psi", "max_psi"))
    exports.write_csv(drift.baseline_stats(customers), f"{tables}/feature_stats")

    # Churn models.
    result = churn.train_churn_models(churn.training_rows(customers, seed=seed), sizes, seed)
    board = materialize(result.board)
    exports.write_csv(board, f"{tables}/churn_models")
    best = result.best
    best_calibration = calibration(result.scores.where(F.col("model") == best))
    exports.write_csv(best_calibration, f"{tables}/churn_calibration")
    status = {"best": best, "lag_days": FEATURE_LAG_DAYS, **{f"error_{k}": v for k, v in result.errors.items()}}
    metrics_log.write_metrics(metrics_log.metric_rows(spark, status), out_dir, "churn")
    model = churn.refit(customers, best, result.params[best], sizes, seed)
    scores = materialize(churn.score(model, customers))
    complete = customers.select("customer_id", *CHURN_FEATURES).na.drop()
    best_metrics = board.where(F.col("model") == best).first()
    registry.save_model(
        model,
        "churn_best",
        best,
        # A holdout of one class has neither.
        metrics={k: best_metrics[k] for k in ("auc_roc", "pr_auc") if best_metrics[k] is not None},
        hyperparams=result.params[best],
        dataset_hash=dataset_fingerprint(complete),
    )

    # Who is at risk, and why: every customer is explained.
    shapley = materialize(attribution.attribution_of(model, complete, complete))
    exports.write_csv(attribution.top_drivers(shapley), f"{tables}/top_drivers")
    exports.write_csv(attribution.global_importance(shapley), f"{tables}/feature_importance")

    # Survival, profit drivers, simulation, cohorts.
    exports.write_csv(survival.kaplan_meier(customers), f"{tables}/km_overall")
    curves = materialize(survival.kaplan_meier_by_segment(customers))
    exports.write_csv(curves, f"{tables}/km_by_segment")
    exports.write_csv(survival.median_survival(curves), f"{tables}/km_median")
    cox = survival.cox_model(customers)
    exports.write_csv(spark.createDataFrame(cox["summary"], survival.COX_SCHEMA), f"{tables}/cox_summary")
    ph_p = min((r["p"] for r in cox["ph_test"]), default=None)
    metrics_log.write_metrics(metrics_log.metric_rows(spark, {"notes": cox["status"], "ph_test_p": ph_p}), out_dir, "survival")
    drivers = materialize(profit_drivers(customers))
    metrics_log.write_metrics(drivers, out_dir, "profit_regression")
    keyed = orders if order_key else materialize(orders.select("revenue", F.monotonically_increasing_id().alias("_order")))
    profit =materialize(monte_carlo_profit(keyed, order_key or "_order", n_draws, n_orders, seed))
    metrics_log.write_metrics(profit, out_dir, "monte_carlo_orders")
    exports.write_csv(cohort_retention(orders, as_of), f"{tables}/cohort_retention_long")
    exports.write_csv(cohort_retention_table(orders, as_of, COHORTS, PERIODS), f"{tables}/cohort_retention")

    # Alerts.
    metric_tables += [
        alerts.metric_row(customers.agg(F.avg("churned").alias("x")), "churn_rate", "x"),
        alerts.metric_row(profit, "margin", "margin_sim"),
    ]
    observed = metric_tables[0]
    for table in metric_tables[1:]:
        observed = observed.unionByName(table)
    rule_table = alerts.rules(spark)
    stale = alerts.evaluate(alerts.model_ages(registry.table()), rule_table)
    found = alerts.evaluate(observed, rule_table).unionByName(stale, allowMissingColumns=True)
    alerts.append_alerts(found, f"{out_dir}/alerts")

    # Star schema and key figures.
    best_forecast = best_model(comparison)
    exports.write_csv(kpi_table(drivers, profit, best_forecast, board.where(F.col("model") == best)), f"{tables}/kpi_summary")
    named = next(iter(best_forecast.collect()), None)
    last_week = weekly.orderBy(F.desc("week_end")).first()["revenue"]
    exports.write_star_schema(
        exports.customers_dim(customers, as_of),
        exports.orders_fact(orders),
        exports.model_scores_fact(customers, scores, as_of, named["model"] if named else None, last_week),
        f"{out_dir}/bi_export",
    )
    run_facts = {"as_of": as_of.isoformat(), "holdout_weeks": HOLDOUT_WEEKS, "horizon_weeks": HORIZON_WEEKS}
    metrics_log.write_metrics(metrics_log.metric_rows(spark, run_facts), out_dir, "run")
