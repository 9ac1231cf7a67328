from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.operators import alerts, drift
from revenue_lens.operators.accuracy import forecast_metrics
from revenue_lens.operators.blending import blend, member_weights
from revenue_lens.operators.customers import customer_features_at
from revenue_lens.operators.forecasting import baseline_forecasts, best_model, split_series, weekly_series
from revenue_lens.operators.rfm import add_rfm_segments
from revenue_lens.operators.simulation import monte_carlo_profit
from revenue_lens.operators.storage import materialize, shared_folder
from revenue_lens.plans import sql_parts as sql
from revenue_lens.plans.catalog import query, with_ctes
from revenue_lens.plans.forecast_queries import BASELINES, INVERSE_VARIANCE, METRICS, SPLIT, nation_weeks
from revenue_lens.settings import DRIFT_FEATURES
from revenue_lens.sources.orders import latest_order_date, tpch_orders
from revenue_lens.sources.registry import ModelRegistry, metrics_map, registry_summary


def two_snapshots(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features a year before the last order date (baseline) and at it (current), from one scan."""
    last = latest_order_date(orders)
    first = last - dt.timedelta(days=365)
    both = materialize(customer_features_at(orders, [first, last]))
    part = lambda day: both.where(F.col("as_of_date") == F.lit(day)).drop("as_of_date")
    return part(first), part(last)


def _stack(source: str, current: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}::DOUBLE AS value, {current} AS cur FROM {source}" for f in DRIFT_FEATURES)


SNAPSHOTS = (
    sql.O,
    sql.features("f_old", f"({sql.AS_OF} - 365)"),
    sql.features("f_new", sql.AS_OF),
    f"v AS ({_stack('f_old', 'false')} UNION ALL {_stack('f_new', 'true')})",
)

PSI = """rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
bn AS (
  SELECT feature, cur, CASE WHEN hi = lo THEN 9 ELSE (SELECT count(*) FROM range(1, 10) t(i) WHERE value >= lo + i * ((hi - lo) / 10)) END AS bin
  FROM v JOIN rg USING (feature)),
ct AS (
  SELECT f.feature, b.bin, (SELECT count(*) FROM bn WHERE bn.feature = f.feature AND bn.bin = b.bin AND NOT cur) AS nb,
         (SELECT count(*) FROM bn WHERE bn.feature = f.feature AND bn.bin = b.bin AND cur) AS nc
  FROM (SELECT DISTINCT feature FROM v) f CROSS JOIN range(0, 10) b(bin)),
sh AS (
  SELECT feature, (nb + 1e-6::DOUBLE) / (sum(nb) OVER p + 1e-5::DOUBLE) AS pb, (nc + 1e-6::DOUBLE) / (sum(nc) OVER p + 1e-5::DOUBLE) AS pc
  FROM ct WINDOW p AS (PARTITION BY feature)),
psi AS (SELECT feature, sum((pc - pb) * ln(pc / pb)) AS psi FROM sh GROUP BY feature)"""

KS = """kv AS (SELECT feature, value, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM v GROUP BY ALL),
kc AS (
  SELECT feature, sum(b) OVER (PARTITION BY feature ORDER BY value) / sum(b) OVER (PARTITION BY feature) AS f1,
         sum(c) OVER (PARTITION BY feature ORDER BY value) / sum(c) OVER (PARTITION BY feature) AS f2,
         sum(b) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m FROM kv),
ks AS (SELECT feature, max(abs(f1 - f2)) AS ks_stat, any_value(n) AS n, any_value(m) AS m FROM kc GROUP BY feature),
kp AS (
  SELECT feature, ks_stat, sqrt(n * m / (n + m)) * ks_stat AS x FROM ks),
kt AS (
  SELECT feature, ks_stat, CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
    (SELECT sum(2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x)) FROM range(1, 41) t(k)))) END AS p_value FROM kp)"""

LEVEL = "CASE WHEN psi > 0.25 THEN 'CRITICAL' WHEN psi > 0.15 THEN 'WARNING' WHEN psi > 0.05 THEN 'CAUTION' ELSE 'OK' END"


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "drift_baseline_stats",
    with_ctes(
        *SNAPSHOTS,
        select="""SELECT feature, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75
  FROM v WHERE NOT cur GROUP BY feature""",
    ),
)
def q_drift_baseline_stats(spark, sf_dir):
    stats = drift.baseline_stats(two_snapshots(tpch_orders(spark, sf_dir))[0])
    return _rounded(stats, ["mean", "std", "min", "max", "q25", "q50", "q75"])


@query("drift_psi", with_ctes(*SNAPSHOTS, PSI, select="SELECT feature, round(psi, 6) AS psi FROM psi"))
def q_drift_psi(spark, sf_dir):
    return _rounded(drift.psi(drift.both_samples(*two_snapshots(tpch_orders(spark, sf_dir)))), ["psi"])


@query("drift_psi_from_bins", with_ctes(*SNAPSHOTS, PSI, select="SELECT feature, round(psi, 6) AS psi FROM psi"))
def q_drift_psi_from_bins(spark, sf_dir):
    """The same from stored bin counts of the baseline."""
    old, new = two_snapshots(tpch_orders(spark, sf_dir))
    return _rounded(drift.psi_from_bins(drift.baseline_bins(old), old, materialize(new)), ["psi"])


@query(
    "drift_ks_statistic",
    with_ctes(*SNAPSHOTS, KS, select="SELECT feature, round(ks_stat, 6) AS ks_stat, round(p_value, 6)::DOUBLE AS p_value FROM kt"),
)
def q_drift_ks(spark, sf_dir):
    return _rounded(drift.ks(drift.both_samples(*two_snapshots(tpch_orders(spark, sf_dir)))), ["ks_stat", "p_value"])


NATION_RECENCY = """nv AS (
  SELECT n_name AS feature, recency_days::DOUBLE AS value, cur FROM (
    SELECT customer_id, recency_days, false AS cur FROM f_old UNION ALL SELECT customer_id, recency_days, true FROM f_new)
  JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey)"""


@query(
    "drift_small_samples",
    with_ctes(
        *SNAPSHOTS, NATION_RECENCY, KS.replace("FROM v ", "FROM nv "),
        """nm AS (SELECT feature, n::BIGINT AS n, m::BIGINT AS m, round(ks_stat * n * m)::BIGINT AS d FROM ks),
pa AS (
  SELECT feature, n, m, d, 0::BIGINT AS s, 0::BIGINT AS i, 1.0::DOUBLE AS a FROM nm WHERE d > 0 AND n * m <= 10000
  UNION ALL SELECT feature, n, m, d, s1, i1, sum(a * CASE step WHEN 1 THEN i1 ELSE s1 - i1 END / s1) FROM (
    SELECT feature, n, m, d, s + 1 AS s1, i + step AS i1, step, a FROM pa CROSS JOIN (VALUES (0::BIGINT), (1)) t(step))
  WHERE i1 <= n AND s1 - i1 <= m AND abs(i1 * m - (s1 - i1) * n) < d GROUP BY feature, n, m, d, s1, i1)""",
        select="""SELECT feature, round(ks_stat, 6) AS ks_stat,
  round(CASE WHEN n * m <= 10000 THEN greatest(0, 1 - coalesce(a, 0)) ELSE kt.p_value END, 6)::DOUBLE AS p_value
  FROM kt JOIN nm USING (feature) LEFT JOIN (SELECT feature, a FROM pa WHERE s = n + m) e USING (feature)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_drift_small_samples(spark, sf_dir):
    """Recency now against a year ago, nation by nation: samples small enough for exact p-values."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    nations = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("feature"))
    sides = [s.select("customer_id", F.col("recency_days").cast("double").alias("value"), F.lit(bool(k)).alias("is_current")) for k, s in enumerate(two_snapshots(tpch_orders(spark, sf_dir)))]
    return _rounded(drift.ks(sides[0].unionByName(sides[1]).join(nations, "customer_id").drop("customer_id")), ["ks_stat", "p_value"])


@query(
    "drift_report",
    with_ctes(
        *SNAPSHOTS, PSI, KS,
        select=f"""SELECT feature, 'Kolmogorov-Smirnov' AS test, round(ks_stat, 6) AS ks_stat, round(p_value, 6)::DOUBLE AS p_value,
  round(psi, 6) AS psi, {LEVEL} AS alert_level FROM kt JOIN psi USING (feature)""",
    ),
)
def q_drift_report(spark, sf_dir):
    return _rounded(drift.drift_report(*two_snapshots(tpch_orders(spark, sf_dir))), ["ks_stat", "p_value", "psi"])


@query(
    "drift_summary",
    with_ctes(
        *SNAPSHOTS, PSI,
        f"lv AS (SELECT psi, {LEVEL} AS l FROM psi)",
        select="""SELECT round(max(psi), 6) AS max_psi, count(*) AS features,
  CASE max(CASE l WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'CAUTION' THEN 1 ELSE 0 END)
    WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'WARNING' WHEN 1 THEN 'CAUTION' ELSE 'OK' END AS alert_severity FROM lv""",
    ),
)
def q_drift_summary(spark, sf_dir):
    return _rounded(drift.drift_summary(drift.psi_report(*two_snapshots(tpch_orders(spark, sf_dir)))), ["max_psi"])


@query(
    "drift_categorical",
    with_ctes(
        *SNAPSHOTS[:3],
        sql.rfm("rb", "f_old"),
        sql.rfm("rc", "f_new"),
        """cc AS (SELECT rfm_segment, sum(b) AS b, sum(c) AS c FROM (
  SELECT rfm_segment, 1 AS b, 0 AS c FROM rb UNION ALL SELECT rfm_segment, 0, 1 FROM rc) GROUP BY rfm_segment),
tt AS (SELECT sum(b) AS nb, sum(c) AS nc, count(*) AS k FROM cc),
ee AS (
  SELECT b, c, k, (b + 1e-6::DOUBLE) / (nb + 1e-6::DOUBLE * k) AS pb, (c + 1e-6::DOUBLE) / (nc + 1e-6::DOUBLE * k) AS pc,
         (b + c) * nb / (nb + nc) AS xb, (b + c) * nc / (nb + nc) AS xc FROM cc CROSS JOIN tt),
rr AS (SELECT sum((pc - pb) * ln(pc / pb)) AS psi, sum((b - xb) ** 2 / xb + (c - xc) ** 2 / xc) AS chi2, any_value(k) - 1 AS df FROM ee)""",
        select=f"""SELECT 'rfm_segment' AS feature, 'Chi-squared' AS test, round(psi, 6) AS psi, round(chi2, 6) AS chi2,
  df, {LEVEL} AS alert_level FROM rr""",
    ),
)
def q_drift_categorical(spark, sf_dir):
    """RFM segments now against a year ago; the p-value of the statistic has its own test."""
    old, new = (add_rfm_segments(s) for s in two_snapshots(tpch_orders(spark, sf_dir)))
    return _rounded(drift.categorical_drift(old, new, ["rfm_segment"]), ["psi", "chi2"]).drop("p_value")


CDF = """CASE WHEN {z} > 0 THEN 1 - {p} * exp(-({z} * {z} / 2)) / 2 ELSE {p} * exp(-({z} * {z} / 2)) / 2 END"""
POLY = """((1 / (1 + 0.3275911 * abs({z}) / sqrt(2))) * (0.254829592 + (1 / (1 + 0.3275911 * abs({z}) / sqrt(2))) * (-0.284496736
  + (1 / (1 + 0.3275911 * abs({z}) / sqrt(2))) * (1.421413741 + (1 / (1 + 0.3275911 * abs({z}) / sqrt(2))) * (-1.453152027
  + (1 / (1 + 0.3275911 * abs({z}) / sqrt(2))) * 1.061405429)))))"""


def _cdf(z: str) -> str:
    return CDF.replace("{p}", POLY).replace("{z}", z)


@query(
    "drift_psi_from_stats",
    with_ctes(
        *SNAPSHOTS, PSI.split(",\nct AS")[0],
        f"""ms AS (SELECT feature, count(*) AS n, avg(value) AS mu, greatest(stddev_samp(value), 1e-9) AS sd FROM v WHERE NOT cur GROUP BY feature),
ed AS (SELECT feature, n, mu, sd, i, (lo + i * ((hi - lo) / 10) - mu) / sd AS z FROM ms JOIN rg USING (feature) CROSS JOIN range(0, 11) t(i)),
cd AS (SELECT feature, n, i, CASE i WHEN 0 THEN 0.0 WHEN 10 THEN 1.0 ELSE {_cdf('z')} END AS below FROM ed),
xp AS (SELECT feature, i AS bin, n * (lead(below) OVER (PARTITION BY feature ORDER BY i) - below) AS e FROM cd),
cn AS (SELECT feature, bin, count(*) AS c FROM bn WHERE cur GROUP BY ALL),
pr AS (
  SELECT feature, (e + 1e-6) / (sum(e) OVER p + 1e-5) AS pb, (coalesce(c, 0) + 1e-6) / (sum(coalesce(c, 0)) OVER p + 1e-5) AS pc
  FROM xp LEFT JOIN cn USING (feature, bin) WHERE bin < 10 WINDOW p AS (PARTITION BY feature))""",
        select="SELECT feature, round(sum((pc - pb) * ln(pc / pb)), 4) AS psi FROM pr GROUP BY feature",
    ),
)
def q_drift_psi_from_stats(spark, sf_dir):
    baseline, current = two_snapshots(tpch_orders(spark, sf_dir))
    return _rounded(drift.psi_from_stats(drift.baseline_stats(baseline), current), ["psi"], 4)


MONTE_CARLO = """sd AS (SELECT revenue, md5('42|order|' || order_id) AS m FROM o),
co AS (
  SELECT revenue, ('0x' || substr(m, 1, 8))::BIGINT % 2147483647 AS a1, ('0x' || substr(m, 9, 8))::BIGINT % 2147483647 AS c1,
         ('0x' || substr(m, 17, 8))::BIGINT % 2147483647 AS a2, ('0x' || substr(m, 25, 8))::BIGINT % 2147483647 AS c2 FROM sd),
un AS (
  SELECT d, revenue, ((a1 * d + c1) % 2147483647 + 0.5::DOUBLE) / 2147483647::DOUBLE AS u1,
         ((a2 * d + c2) % 2147483647 + 0.5::DOUBLE) / 2147483647::DOUBLE AS u2 FROM co CROSS JOIN range(0, 5000) t(d)),
dr AS (
  SELECT d, sum(revenue * (1 - least(greatest(exp(-0.45::DOUBLE + 0.15::DOUBLE * (sqrt(-2 * ln(u1)) * cos(2 * pi() * u2))), 0.2::DOUBLE), 0.95::DOUBLE))) AS total,
         count(*) AS orders FROM un GROUP BY d),
mc AS (
  SELECT max(orders) AS n_orders_in_sim, count(*) AS n_draws, avg(total) AS mean_total_profit, quantile_cont(total, 0.05) AS p5,
         quantile_cont(total, 0.5) AS p50, quantile_cont(total, 0.95) AS p95, stddev_pop(total) AS std,
         avg(total) / (SELECT sum(revenue::DECIMAL(18,2))::DOUBLE FROM o) AS margin_reference,
         avg(total) / (SELECT sum(revenue::DECIMAL(18,2))::DOUBLE FROM o) AS margin_sim FROM dr)"""


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their key, which the simulation samples by."""
    return tpch_orders(spark, sf_dir, ["o_orderkey"])


def profit_of(orders: DataFrame) -> DataFrame:
    return materialize(monte_carlo_profit(orders, "o_orderkey"))


@query(
    "monte_carlo_profit",
    with_ctes(
        sql.O, MONTE_CARLO,
        select="""SELECT n_orders_in_sim, n_draws, round(mean_total_profit, 2) AS mean_total_profit, round(p5, 2) AS p5,
  round(p50, 2) AS p50, round(p95, 2) AS p95, round(std, 2) AS std, round(margin_reference, 6) AS margin_reference,
  round(margin_sim, 6) AS margin_sim FROM mc""",
    ),
)
def q_monte_carlo_profit(spark, sf_dir):
    money = _rounded(monte_carlo_profit(keyed_orders(spark, sf_dir), "o_orderkey"), ["mean_total_profit", "p5", "p50", "p95", "std"], 2)
    return _rounded(money, ["margin_reference", "margin_sim"])


def company_baselines(orders: DataFrame) -> DataFrame:
    return baseline_forecasts(split_series(weekly_series(orders)))


COMPANY = (sql.weekly("w", "o"), SPLIT, BASELINES, METRICS, INVERSE_VARIANCE)


def run_metrics(orders: DataFrame) -> DataFrame:
    """The (metric, value) rows the alert rules look at."""
    baseline, current = two_snapshots(orders)
    forecasts = materialize(company_baselines(orders))
    blended = blend(forecasts, member_weights(forecasts))
    tables = [
        alerts.metric_row(current.agg(F.avg("churned").alias("x")), "churn_rate", "x"),
        alerts.metric_row(profit_of(orders), "margin", "margin_sim"),
        alerts.metric_row(forecast_metrics(blended), "mape", "mape"),
        alerts.metric_row(drift.drift_summary(drift.psi_report(baseline, current)), "max_psi", "max_psi"),
    ]
    result = tables[0]
    for t in tables[1:]:
        result = result.unionByName(t)
    return result


ALERT_METRICS = """am AS (
  SELECT 'churn_rate' AS metric, avg(churned) AS value FROM f_new
  UNION ALL SELECT 'margin', margin_sim FROM mc
  UNION ALL SELECT 'mape', avg(abs(y_true - y) / greatest(abs(y_true), 1e-9)) FROM (
    SELECT step, any_value(y_true) AS y_true, sum(weight * y_pred) AS y FROM h JOIN wt USING (series_key, model) GROUP BY step)
  UNION ALL SELECT 'max_psi', max(psi) FROM psi),
al AS (
  SELECT 'churn_spike' AS rule, 'WARNING' AS severity, value, 0.2::DOUBLE + 3 * 0.05::DOUBLE AS threshold,
    printf('Churn rate %.1f%% exceeds threshold %.1f%% (mean + 3.0σ)', value * 100, 35.0::DOUBLE) AS message
  FROM am WHERE metric = 'churn_rate' AND value > 0.2::DOUBLE + 3 * 0.05::DOUBLE
  UNION ALL SELECT 'margin_decline', 'CRITICAL', value, -0.01::DOUBLE,
    printf('Net margin %.2f%% below minimum %.2f%%', value * 100, -1.0::DOUBLE) FROM am WHERE metric = 'margin' AND value < -0.01
  UNION ALL SELECT 'forecast_error', 'CAUTION', value, 0.05::DOUBLE,
    printf('Forecast MAPE %.2f%% exceeds %.2f%%', value * 100, 5.0::DOUBLE) FROM am WHERE metric = 'mape' AND value > 0.05
  UNION ALL SELECT 'data_drift', 'WARNING', value, 0.15::DOUBLE,
    printf('Data drift PSI %.3f exceeds %.3f', value, 0.15::DOUBLE) FROM am WHERE metric = 'max_psi' AND value > 0.15)"""


@query(
    "alerts",
    with_ctes(
        *SNAPSHOTS, PSI, MONTE_CARLO, *COMPANY, ALERT_METRICS,
        select="SELECT rule, severity, message, round(value, 6) AS value, round(threshold, 6) AS threshold FROM al",
    ),
)
def q_alerts(spark, sf_dir):
    found = alerts.evaluate(run_metrics(keyed_orders(spark, sf_dir)), alerts.rules(spark))
    return _rounded(found.select("rule", "severity", "message", "value", "threshold"), ["value", "threshold"])


@query(
    "margin_alert",
    with_ctes(
        sql.O, MONTE_CARLO,
        select="""SELECT 'margin_decline' AS rule, 'CRITICAL' AS severity, round(margin_sim, 6) AS value, 0.9::DOUBLE AS threshold,
  printf('Net margin %.2f%% below minimum %.2f%%', margin_sim * 100, 90.0::DOUBLE) AS message FROM mc WHERE margin_sim < 0.9""",
    ),
)
def q_margin_alert(spark, sf_dir):
    """The margin rule with a minimum that no simulated margin reaches."""
    margin = alerts.metric_row(profit_of(keyed_orders(spark, sf_dir)), "margin", "margin_sim")
    found = alerts.evaluate(margin, alerts.rules(spark, thresholds={"margin_decline": 0.9}))
    return _rounded(found.select("rule", "severity", "value", "threshold", "message"), ["value"])


REGISTERED_HOLDOUTS = (4, 13, 26)


def forecast_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of the nation baselines, one version per training end."""
    weeks = materialize(nation_weeks(spark, sf_dir))
    result = None
    for holdout in REGISTERED_HOLDOUTS:
        forecasts = baseline_forecasts(split_series(weeks, holdout))
        ends = forecasts.where("step = 0").select("series_key", "model", F.col("week_end").alias("trained"))
        rows = forecast_metrics(forecasts).join(ends, ["series_key", "model"]).select(
            F.concat_ws("_", F.lit("forecast"), "model", "series_key").alias("name"),
            F.date_format("trained", "yyyyMMdd_000000").alias("version"),
            F.col("model").alias("model_type"),
            metrics_map("rmse", "smape").alias("metrics"),
            F.col("trained").cast("timestamp").alias("created_at"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def _registry_sql() -> str:
    parts, union = [], []
    for h in REGISTERED_HOLDOUTS:
        split = SPLIT.replace("s AS (", f"s{h} AS (", 1).replace("n - 26", f"n - {h}")
        base = (
            BASELINES.replace("b AS (", f"b{h} AS (", 1).replace("fc AS (", f"fc{h} AS (").replace("h AS (", f"h{h} AS (")
            .replace("FROM s WHERE n > 34", f"FROM s{h} WHERE n > {h + 8}").replace("FROM b", f"FROM b{h}")
            .replace("27 - n", f"{h + 1} - n").replace("n - 26 - 1", f"n - {h} - 1").replace("FROM fc ", f"FROM fc{h} ")
        )
        metrics = METRICS.replace("me AS (", f"me{h} AS (", 1).replace("FROM h ", f"FROM h{h} ")
        parts += [split, base, metrics]
        union.append(
            f"""SELECT 'forecast_' || model || '_' || series_key AS name, strftime(trained, '%Y%m%d_000000') AS version, rmse, smape, trained
  FROM me{h} JOIN (SELECT series_key, week_end AS trained FROM s{h} WHERE step = 0) USING (series_key)"""
        )
    return ",\n".join([*parts, "reg AS (" + " UNION ALL ".join(union) + ")"])


REGISTRY = (sql.NATION_ORDERS, sql.weekly("w", "no", "series_key"), _registry_sql())


@query(
    "registry_summary",
    with_ctes(
        *REGISTRY,
        select="""SELECT name, count(DISTINCT version) AS total_versions, max(version) AS latest_version,
  round(arg_max(rmse, version), 4) AS latest_rmse, round(arg_max(smape, version), 6) AS latest_smape FROM reg GROUP BY name""",
    ),
)
def q_registry_summary(spark, sf_dir):
    latest = F.col("latest_metrics")
    return registry_summary(forecast_registry(spark, sf_dir)).select(
        "name", "total_versions", "latest_version",
        F.round(latest["rmse"], 4).alias("latest_rmse"), F.round(latest["smape"], 6).alias("latest_smape"),
    )


@query(
    "model_staleness",
    with_ctes(
        sql.O, *REGISTRY,
        f"""ag AS (SELECT name, date_diff('day', arg_max(trained, version), {sql.AS_OF})::DOUBLE AS value FROM reg GROUP BY name)""",
        select="""SELECT name, 'model_staleness' AS rule, 'CAUTION' AS severity, value, 30.0::DOUBLE AS threshold,
  printf('Model last trained %d days ago (limit: %d)', value::BIGINT, 30) AS message FROM ag WHERE value > 30""",
    ),
)
def q_model_staleness(spark, sf_dir):
    """Age of the latest version at the last order date."""
    now = F.lit(latest_order_date(tpch_orders(spark, sf_dir))).cast("timestamp")
    return alerts.evaluate(alerts.model_ages(forecast_registry(spark, sf_dir), now), alerts.rules(spark))


def company_best_forecast(orders: DataFrame) -> DataFrame:
    return best_model(forecast_metrics(company_baselines(orders)))


@query(
    "registered_models",
    with_ctes(
        sql.O, *COMPANY,
        select="""SELECT model AS name, count(*) AS versions, '0002' AS latest_version, round(max(rmse), 4) AS rmse FROM (
  SELECT model, rmse FROM me UNION ALL SELECT model, rmse FROM me) GROUP BY model""",
    ),
)
def q_registered_models(spark, sf_dir):
    """The company's baseline forecasts saved twice in a registry, and what it lists of them."""
    metrics = forecast_metrics(company_baselines(tpch_orders(spark, sf_dir))).collect()  # a row per model
    registry = ModelRegistry(spark, f"{shared_folder(spark)}/registry/{uuid.uuid4().hex}")
    for version in ("0001", "0002"):
        for r in metrics:
            registry.register(r["model"], version, None, "baseline", {"rmse": r["rmse"]})
    rows = [(name, len(registry.list_versions(name)), max(registry.list_versions(name)), registry.get_metrics(name)["rmse"]) for name in registry.list_models()]
    return _rounded(spark.createDataFrame(rows, "name string, versions bigint, latest_version string, rmse double"), ["rmse"], 4)
