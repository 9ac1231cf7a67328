from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.functions.scoring import HEURISTIC_WEIGHTS
from revenue_lens.operators import attribution, boosting, churn, lloyd, segments, survival
from revenue_lens.operators.accuracy import forecast_metrics
from revenue_lens.operators.customers import customer_features
from revenue_lens.operators.forecasting import baseline_forecasts, best_model, split_series, weekly_series
from revenue_lens.operators.ranking_metrics import calibration, leaderboard, ranking_metrics
from revenue_lens.operators.regression import profit_drivers
from revenue_lens.operators.rfm import SEGMENTS, add_rfm_segments
from revenue_lens.operators.storage import materialize, shared_folder
from revenue_lens.plans import sql_parts as sql
from revenue_lens.plans.catalog import query, with_ctes
from revenue_lens.plans.customer_queries import features_now, features_of, rfm_now, scored_now
from revenue_lens.plans.monitoring_queries import COMPANY, MONTE_CARLO, company_best_forecast, keyed_orders, profit_of
from revenue_lens.settings import BEHAVIOUR_FEATURES, CHURN_FEATURES
from revenue_lens.sources import exports
from revenue_lens.sources.orders import latest_order_date, tpch_orders, with_reject_reason
from revenue_lens.sources.registry import dataset_fingerprint

FEATURES = (sql.O, sql.features("f", sql.AS_OF))
RFM = (*FEATURES, sql.rfm("r", "f"))


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- survival -------------------------------------------------------------------------


def _km_sql(segment: str, having: str) -> str:
    return f"""g AS (SELECT *, {segment} AS segment FROM r),
big AS (SELECT segment FROM g GROUP BY segment HAVING {having}),
dy AS (SELECT segment, duration_days AS t, count(*) AS n, sum(event_observed)::BIGINT AS events FROM g JOIN big USING (segment) GROUP BY ALL),
d0 AS (SELECT * FROM dy UNION ALL SELECT segment, 0, 0, 0 FROM big),
rk AS (SELECT segment, t, events, (SELECT sum(n) FROM d0 x WHERE x.segment = d0.segment AND x.t >= d0.t)::BIGINT AS at_risk FROM d0),
km AS (SELECT segment, t, at_risk, events, product(1 - events / at_risk) OVER (PARTITION BY segment ORDER BY t) AS survival FROM rk)"""


KM_ALL = _km_sql("'all'", "count(*) >= 40")
KM_SEGMENT = _km_sql("rfm_segment", "count(*) >= 10 AND (SELECT count(DISTINCT rfm_segment) FROM r) > 1")
KM_SELECT = "SELECT segment, t, at_risk, events, round(survival, 6) AS survival FROM km"


@query("km_overall", with_ctes(*RFM, KM_ALL, select=KM_SELECT))
def q_km_overall(spark, sf_dir):
    return _rounded(survival.kaplan_meier(features_of(tpch_orders(spark, sf_dir))), ["survival"])


@query("km_by_segment", with_ctes(*RFM, KM_SEGMENT, select=KM_SELECT))
def q_km_by_segment(spark, sf_dir):
    return _rounded(survival.kaplan_meier_by_segment(rfm_now(spark, sf_dir)), ["survival"])


@query(
    "km_median",
    with_ctes(*RFM, KM_SEGMENT, select="SELECT segment, min(t) FILTER (survival <= 0.5) AS median_days FROM km GROUP BY segment"),
)
def q_km_median(spark, sf_dir):
    return survival.median_survival(survival.kaplan_meier_by_segment(rfm_now(spark, sf_dir)))


@query("cox_summary")
def q_cox_summary(spark, sf_dir):
    return survival.cox_summary(features_now(spark, sf_dir))


@query("ph_test")
def q_ph_test(spark, sf_dir):
    return survival.proportional_hazards_test(features_now(spark, sf_dir))


# --- regression -----------------------------------------------------------------------

OLS = """y AS (
  SELECT ln(1 + greatest(monetary_365d, 0)) AS y, frequency_365d::DOUBLE AS a, recency_days::DOUBLE AS b, tenure_days::DOUBLE AS c FROM f),
mo AS (
  SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, var_pop(y) AS vy, var_pop(a) AS aa, var_pop(b) AS bb,
         var_pop(c) AS cc, covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay,
         covar_pop(b, y) AS byy, covar_pop(c, y) AS cy FROM y),
dt AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM mo),
be AS (
  SELECT *, (ay * (bb * cc - bc * bc) - ab * (byy * cc - bc * cy) + ac * (byy * bc - bb * cy)) / det AS ka,
         (aa * (byy * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - byy * ac)) / det AS kb,
         (aa * (bb * cy - byy * bc) - ab * (ab * cy - byy * ac) + ay * (ab * bc - bb * ac)) / det AS kc FROM dt),
fi AS (SELECT *, (ka * ay + kb * byy + kc * cy) / vy AS r2, n * (vy - ka * ay - kb * byy - kc * cy) AS ssr FROM be),
ol AS (
  SELECT *, 1 - (1 - r2) * (n - 1) / (n - 4) AS r2_adj, n * (ln(2 * pi()) + ln(ssr / n) + 1) + 8 AS aic,
         n * (ln(2 * pi()) + ln(ssr / n) + 1) + 4 * ln(n) AS bic FROM fi)"""


@query(
    "ols_profit_drivers",
    with_ctes(
        *FEATURES, OLS,
        select=" UNION ALL ".join(
            f"""SELECT '{t}' AS term, round({c}, 6) AS coef, round(r2, 6) AS r2, round(r2_adj, 6) AS r2_adj,
  round(aic, 4) AS aic, round(bic, 4) AS bic, n FROM ol"""
            for t, c in (
                ("frequency_365d", "ka"), ("recency_days", "kb"), ("tenure_days", "kc"), ("const", "my - ka * ma - kb * mb - kc * mc"),
            )
        ),
    ),
)
def q_ols(spark, sf_dir):
    """The p-values come from the same fit; see the query `ols_p_values`."""
    table = profit_drivers(features_now(spark, sf_dir)).drop("p_value")
    return _rounded(_rounded(table, ["coef", "r2", "r2_adj"]), ["aic", "bic"], 4)


@query("ols_p_values")
def q_ols_p_values(spark, sf_dir):
    return profit_drivers(features_now(spark, sf_dir)).select("term", "p_value")


# --- churn plumbing and exact metrics -------------------------------------------------


@query(
    "stratified_split",
    with_ctes(
        *FEATURES,
        select="""SELECT customer_id, churned, row_number() OVER (PARTITION BY churned ORDER BY h, customer_id)
    <= floor(count(*) OVER (PARTITION BY churned) * 0.25::DOUBLE + 0.5::DOUBLE) AS is_test
  FROM (SELECT *, ('0x' || substr(md5('42|' || customer_id), 1, 13))::BIGINT AS h FROM f)""",
    ),
)
def q_stratified_split(spark, sf_dir):
    return churn.stratified_split(features_now(spark, sf_dir)).select("customer_id", "churned", "is_test")


@query(
    "sample_weights",
    with_ctes(
        *FEATURES,
        select="""SELECT customer_id, churned, round(ln(1 + greatest(lag_clv_proxy, 0)), 6) AS w,
  round(ln(1 + greatest(lag_clv_proxy, 0)) * count(*) OVER () / ((SELECT count(DISTINCT churned) FROM f) * count(*) OVER (PARTITION BY churned)), 6) AS w_balanced
  FROM f""",
    ),
)
def q_sample_weights(spark, sf_dir):
    weighted = churn.sample_weights(features_now(spark, sf_dir))
    return _rounded(weighted.select("customer_id", "churned", "w", "w_balanced"), ["w", "w_balanced"])


def heuristic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_now(features_of(tpch_orders(spark, sf_dir)))
    return scored.select(
        F.lit("heuristic").alias("model"), "customer_id", F.col("churned").alias("label"), F.col("churn_probability").alias("prob")
    )


SCORED = (*FEATURES, sql.scores("hs", "f"))

RANKING = """cv AS (SELECT churn_probability AS p, sum(churned) AS pos, sum(1 - churned) AS neg FROM hs GROUP BY churn_probability),
cu AS (
  SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
         sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM cv),
rm AS (
  SELECT sum(pos * (below + neg / 2)) / any_value(np::DOUBLE * nn) AS auc, sum(pos / np * tp / (tp + fp)) AS ap,
         any_value(np)::BIGINT AS np, any_value(nn)::BIGINT AS nn FROM cu)"""


@query(
    "roc_auc",
    with_ctes(
        *SCORED,
        select="""SELECT 'heuristic' AS model, round(auc, 6) AS auc_roc, np AS positives, nn AS negatives FROM (
  SELECT (sum(rk) FILTER (churned = 1) - any_value(np) * (any_value(np) + 1) / 2) / (any_value(np)::DOUBLE * any_value(nn)) AS auc,
         any_value(np) AS np, any_value(nn) AS nn FROM (
    SELECT churned, avg(rn) OVER (PARTITION BY churn_probability) AS rk, count(*) FILTER (churned = 1) OVER () AS np,
           count(*) FILTER (churned = 0) OVER () AS nn
    FROM (SELECT *, row_number() OVER (ORDER BY churn_probability) AS rn FROM hs)))""",
    ),
)
def q_roc_auc(spark, sf_dir):
    return _rounded(ranking_metrics(heuristic_scores(spark, sf_dir)).drop("pr_auc"), ["auc_roc"])


@query("average_precision", with_ctes(*SCORED, RANKING, select="SELECT 'heuristic' AS model, round(ap, 6) AS pr_auc FROM rm"))
def q_average_precision(spark, sf_dir):
    return _rounded(ranking_metrics(heuristic_scores(spark, sf_dir)).select("model", "pr_auc"), ["pr_auc"])


@query(
    "calibration",
    with_ctes(
        *SCORED,
        select="""SELECT 'heuristic' AS model, greatest(ceil(churn_probability * 8) - 1, 0)::INTEGER AS bin,
  round(avg(churned), 6) AS observed, round(avg(churn_probability), 6) AS predicted, count(*) AS n FROM hs GROUP BY bin""",
    ),
)
def q_calibration(spark, sf_dir):
    return _rounded(calibration(heuristic_scores(spark, sf_dir)), ["observed", "predicted"])


@query(
    "risk_tiers",
    with_ctes(
        *SCORED, select="SELECT customer_id, churn_probability, risk_tier, 'heuristic_fallback' AS model_version FROM hs"
    ),
)
def q_risk_tiers(spark, sf_dir):
    return churn.score_requests(features_of(tpch_orders(spark, sf_dir)))


@query(
    "request_validation",
    with_ctes(
        *FEATURES,
        select="""SELECT customer_id, nullif(concat_ws('; ', CASE WHEN customer_id < 1 THEN 'customer_id < 1' END,
    CASE WHEN c_acctbal IS NULL THEN 'clv_proxy is missing' WHEN c_acctbal < 0 THEN 'clv_proxy < 0' END), '') AS reject_reason
  FROM f LEFT JOIN customer ON c_custkey = customer_id""",
    ),
)
def q_request_validation(spark, sf_dir):
    """Requests whose CLV field comes from the account balance, which may be negative."""
    balances = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("clv_proxy")
    )
    requests = features_of(tpch_orders(spark, sf_dir)).drop("clv_proxy").join(balances, "customer_id", "left")
    return with_reject_reason(requests).select("customer_id", "reject_reason")


#: Runs of this application by the data they were trained on; their tables lie in the shared folder.
_RUNS: dict[tuple[str, str], churn.ChurnRun] = {}


def churn_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, churn.ChurnRun]:
    """Customers and the comparison of all models on them, trained once for the queries that need it. A model that fails
    fails the query: a comparison of the others would look like the whole one."""
    customers = features_now(spark, sf_dir)
    rows = churn.training_rows(customers)
    name = (spark.sparkContext.applicationId, dataset_fingerprint(rows))
    if name not in _RUNS:
        _RUNS[name] = churn.train_churn_models(rows).whole()
    return customers, _RUNS[name]


@query("churn_leaderboard")
def q_churn_leaderboard(spark, sf_dir):
    return leaderboard(churn_run(spark, sf_dir)[1].metrics)


@query("churn_scores")
def q_churn_scores(spark, sf_dir):
    customers, run = churn_run(spark, sf_dir)
    model = churn.refit(customers, run.best, run.params[run.best])
    return churn.score(model, customers)


LAGGED_ROWS = f"tr AS (SELECT customer_id, churned, {', '.join(CHURN_FEATURES)}, round(ln(1 + greatest(lag_clv_proxy, 0)) * 1048576)::BIGINT AS w FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CHURN_FEATURES)})"


@query(
    "churn_folds",
    with_ctes(
        *FEATURES,
        LAGGED_ROWS,
        "n AS (SELECT churned, count(*) - floor(count(*) * 0.25 + 0.5)::BIGINT AS n FROM tr GROUP BY churned)",
        select="SELECT churned, fold::INTEGER AS fold, ((fold + 1) * n // 5 - fold * n // 5)::BIGINT AS n_rows FROM n, range(5) AS r(fold)",
    ),
)
def q_churn_folds(spark, sf_dir):
    """Rows of each class in each fold of the training part."""
    rows = churn.training_rows(features_now(spark, sf_dir)).where("NOT is_test")
    return rows.groupBy("churned", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


_PLACES = ", ".join(f"floor((count(*) OVER (ORDER BY {c}) - 1) * 256 / count(*) OVER ())::BIGINT AS b{i}" for i, c in enumerate(CHURN_FEATURES))
_BINS = ", ".join(f"b{i}" for i in range(len(CHURN_FEATURES)))


@query(
    "boosting_root_gains",
    with_ctes(
        *FEATURES,
        LAGGED_ROWS,
        f"bi AS (SELECT *, {_PLACES} FROM tr)",
        "ba AS (SELECT sum(w) FILTER (churned = 1) / sum(w)::DOUBLE AS p FROM tr)",
        f"ce AS (SELECT {_BINS}, churned, count(*) AS n, sum(w)::BIGINT AS w FROM bi GROUP BY ALL)",
        f"gr AS (SELECT {_BINS}, n, round((p - churned) * w) AS g, round(p * (1 - p) * w) AS h FROM ce, ba)",
        "hi AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, b{i} AS bin, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM gr GROUP BY bin" for i, c in enumerate(CHURN_FEATURES)) + ")",
        "en AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, b{i} AS bin, max({c})::DOUBLE AS cut FROM bi GROUP BY bin" for i, c in enumerate(CHURN_FEATURES)) + ")",
        """cu AS (SELECT feature, bin, cut, sum(g) OVER l / 1048576 AS gl, sum(h) OVER l / 1048576 AS hl, sum(n) OVER l AS nl,
  sum(g) OVER a / 1048576 AS ga, sum(h) OVER a / 1048576 AS ha, sum(n) OVER a AS na FROM hi JOIN en USING (feature, bin)
  WINDOW l AS (PARTITION BY feature ORDER BY bin), a AS (PARTITION BY feature))""",
        select="""SELECT feature, cut, nl::BIGINT AS rows_left, round(gl ** 2 / hl + (ga - gl) ** 2 / (ha - hl) - ga ** 2 / ha, 6) AS gain
  FROM cu WHERE nl >= 20 AND na - nl >= 20 AND hl >= 0.001 AND ha - hl >= 0.001""",
    ),
)
def q_boosting_root_gains(spark, sf_dir):
    """Every split that the first tree's root may take, over all customers."""
    customers = churn.sample_weights(features_now(spark, sf_dir).select("customer_id", "churned", *CHURN_FEATURES).na.drop())
    booster = churn.boosters("hist_gradient_boosting")[0][1]
    return _rounded(boosting.root_gains(customers, CHURN_FEATURES, "churned", booster), ["gain"])


@query("shap_values")
def q_shap_values(spark, sf_dir):
    """Every customer explained, for the boosted model."""
    customers = features_now(spark, sf_dir)
    model = churn.refit(customers, "hist_gradient_boosting", None)
    return attribution.attribution_of(model, customers, customers)


# --- linear attribution ---------------------------------------------------------------

LINEAR = "me AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in HEURISTIC_WEIGHTS) + " FROM f),\nla AS (" + " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, {w}::DOUBLE * ({c} - m_{c}) AS phi FROM f CROSS JOIN me" for c, w in HEURISTIC_WEIGHTS.items()
) + ")"


@query("shap_linear", with_ctes(*FEATURES, LINEAR, select="SELECT customer_id, feature, round(phi, 6) AS phi FROM la"))
def q_shap_linear(spark, sf_dir):
    phi = attribution.linear_attribution(features_now(spark, sf_dir))
    return _rounded(attribution.long_attribution(phi), ["phi"])


@query(
    "feature_importance_linear",
    with_ctes(*FEATURES, LINEAR, select="SELECT feature, round(avg(abs(phi)), 6) AS importance FROM la GROUP BY feature"),
)
def q_feature_importance(spark, sf_dir):
    return _rounded(attribution.global_importance(attribution.linear_attribution(features_now(spark, sf_dir))), ["importance"])


@query(
    "top_drivers",
    with_ctes(
        *FEATURES, LINEAR,
        select="""SELECT * FROM (SELECT customer_id, feature, round(phi, 6) AS contribution,
  row_number() OVER (PARTITION BY customer_id ORDER BY abs(phi) DESC, feature)::INTEGER AS position FROM la) WHERE position <= 5""",
    ),
)
def q_top_drivers(spark, sf_dir):
    return _rounded(attribution.top_drivers(attribution.linear_attribution(features_now(spark, sf_dir))), ["contribution"])


# --- clusters -------------------------------------------------------------------------


def banded(customers: DataFrame) -> DataFrame:
    """A deterministic cluster label (trailing order count, 5 and more together): K-Means
    labels depend on the random start, so the checked queries use this one."""
    return customers.withColumn(segments.CLUSTER, F.least("frequency_365d", F.lit(5)).cast("int"))


@query(
    "cluster_rfm_crosstab",
    with_ctes(
        *RFM,
        "b AS (SELECT least(frequency_365d, 5)::INTEGER AS kmeans_cluster, rfm_segment FROM r)",
        select="SELECT kmeans_cluster, "
        + ", ".join(f"count(*) FILTER (rfm_segment = '{s}') / count(*) AS {s}" for s in SEGMENTS)
        + " FROM b GROUP BY kmeans_cluster",
    ),
)
def q_cluster_rfm_crosstab(spark, sf_dir):
    return segments.cluster_segment_crosstab(banded(rfm_now(spark, sf_dir)))


@query("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    return segments.kmeans_segmentation(features_now(spark, sf_dir))[0].select("customer_id", segments.CLUSTER)


_SZ = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z{i}" for i, c in enumerate(BEHAVIOUR_FEATURES))
_N = range(len(BEHAVIOUR_FEATURES))


@query(
    "kmeans_step",
    with_ctes(
        *RFM,
        f"z AS (SELECT customer_id, rfm_segment, {_SZ} FROM r)",
        f"ce AS (SELECT list_position({SEGMENTS!r}, rfm_segment) AS c, {', '.join(f'avg(z{i}) AS m{i}' for i in _N)} FROM z GROUP BY rfm_segment)",
        f"di AS (SELECT customer_id, c, {', '.join(f'z{i}' for i in _N)}, {' + '.join(f'(z{i} - m{i}) ** 2' for i in _N)} AS d FROM z CROSS JOIN ce)",
        "ne AS (SELECT * FROM di QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY d, c) = 1)",
        select=f"SELECT c::INTEGER AS cluster, count(*) AS n, round(sum(d), 6) AS cost, {', '.join(f'round(avg(z{i}), 6) AS centre_{c}' for i, c in enumerate(BEHAVIOUR_FEATURES))} FROM ne GROUP BY c",
    ),
)
def q_kmeans_step(spark, sf_dir):
    """One step from the centres of the RFM segments: points, cost and the next centres."""
    points = segments.standardised(rfm_now(spark, sf_dir)).select("rfm_segment", vector_to_array("x").alias("x"))
    stored = materialize(points)
    number = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("rfm_segment")).cast("int")
    means = stored.groupBy(number.alias("c")).agg(*[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in _N]).orderBy("c").collect()  # a row per segment
    step = lloyd.lloyd_sums(stored.select("x"), {0: np.array([[r[f"m{i}"] for i in _N] for r in means])})
    named = F.get(F.array(*[F.lit(r["c"]) for r in means]), F.col("cluster")).alias("cluster")
    centre = [F.round(F.get("sums", F.lit(i)) / F.col("n"), 6).alias(f"centre_{c}") for i, c in enumerate(BEHAVIOUR_FEATURES)]
    return step.select(named, "n", F.round("cost", 6).alias("cost"), *centre)


@query("silhouette_by_k")
def q_silhouette_by_k(spark, sf_dir):
    points = materialize(segments.standardised(features_now(spark, sf_dir)))
    found = segments.kmeans_by_k(points)
    return spark.createDataFrame([(k, s) for k, (_, s) in found.items()], "k int, silhouette double")


_Z = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z{i}" for i, c in enumerate(BEHAVIOUR_FEATURES))
_D = " + ".join(f"(x.z{i} - y.z{i}) ** 2" for i in range(len(BEHAVIOUR_FEATURES)))


@query(
    "silhouette_of_rfm_segments",
    with_ctes(
        *RFM,
        f"z AS (SELECT customer_id, rfm_segment AS g, {_Z} FROM r)",
        f"""dd AS (
  SELECT x.customer_id, x.g, y.g AS other, sum({_D}) AS total, count(*) AS n FROM z x CROSS JOIN z y GROUP BY ALL),
ab AS (
  SELECT customer_id, max(total / (n - 1)) FILTER (g = other AND n > 1) AS a, min(total / n) FILTER (g <> other) AS b FROM dd GROUP BY customer_id)""",
        select="SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab",
    ),
)
def q_silhouette_of_rfm_segments(spark, sf_dir):
    """Squared-distance silhouette of the six RFM segments as a clustering."""
    points = segments.standardised(rfm_now(spark, sf_dir))
    number = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("rfm_segment")).cast("int")
    value = segments.silhouette(materialize(points.withColumn(segments.CLUSTER, number)))
    return spark.createDataFrame([(value,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


# --- star schema and key figures ------------------------------------------------------


@query(
    "customers_dim",
    with_ctes(
        *RFM,
        select=f"""SELECT customer_id, first_purchase, last_purchase, recency_days, frequency_365d, monetary_365d, tenure_days,
  rfm_segment, least(frequency_365d, 5)::INTEGER AS kmeans_cluster, churned, clv_proxy, strftime({sql.AS_OF}, '%Y-%m-%d') AS as_of_date FROM r""",
    ),
)
def q_customers_dim(spark, sf_dir):
    orders = tpch_orders(spark, sf_dir)
    as_of = latest_order_date(orders)
    return exports.customers_dim(banded(add_rfm_segments(materialize(customer_features(orders, as_of)))), as_of)


@query("export_round_trip", with_ctes(*RFM, select=f"""SELECT customer_id, first_purchase, last_purchase, recency_days, frequency_365d, monetary_365d, tenure_days,
  rfm_segment, least(frequency_365d, 5)::INTEGER AS kmeans_cluster, churned, clv_proxy, strftime({sql.AS_OF}, '%Y-%m-%d') AS as_of_date FROM r"""))
def q_export_round_trip(spark, sf_dir):
    """The customer dimension as read back from the files of a star-schema export."""
    orders = tpch_orders(spark, sf_dir)
    as_of = latest_order_date(orders)
    customers = scored_now(banded(add_rfm_segments(materialize(customer_features(orders, as_of))))).withColumnRenamed("churn_probability", "churn_prob")
    folder = f"{shared_folder(spark)}/export/{uuid.uuid4().hex}"
    dim = exports.customers_dim(customers, as_of)
    exports.write_star_schema(dim, exports.orders_fact(orders), exports.model_scores_fact(customers, None, as_of, None, None), folder)
    return spark.read.schema(dim.schema).parquet(f"{folder}/customers_dim.parquet")


@query("export_csv", with_ctes(sql.O, select="SELECT customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, revenue, category FROM o"))
def q_export_csv(spark, sf_dir):
    """The orders as read back from the CSV files of an export."""
    fact = exports.orders_fact(tpch_orders(spark, sf_dir))
    folder = f"{shared_folder(spark)}/export/{uuid.uuid4().hex}"
    exports.write_csv(fact, folder)
    return spark.read.schema(fact.schema).option("header", True).csv(folder)


@query(
    "scores_of_some_customers",
    with_ctes(
        *RFM, sql.scores("hs", "r"),
        select=f"""SELECT customer_id, strftime({sql.AS_OF}, '%Y-%m-%d') AS as_of_date, rfm_segment, least(frequency_365d, 5)::INTEGER AS kmeans_cluster,
  CASE WHEN churned = 0 THEN churn_probability END AS churn_prob, duration_days, event_observed, 'n/a' AS forecast_model_best,
  NULL::DOUBLE AS weekly_revenue_last FROM hs""",
    ),
)
def q_scores_of_some_customers(spark, sf_dir):
    """Scores exist for customers who have not churned; the others keep their row without one."""
    orders = tpch_orders(spark, sf_dir)
    as_of = latest_order_date(orders)
    customers = materialize(banded(add_rfm_segments(materialize(customer_features(orders, as_of)))))
    scores = scored_now(customers).where("churned = 0").select("customer_id", F.col("churn_probability").alias("churn_prob"))
    return exports.model_scores_fact(customers, scores, as_of, None, None)


@query(
    "orders_fact",
    with_ctes(sql.O, select="SELECT customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, revenue, category FROM o"),
)
def q_orders_fact(spark, sf_dir):
    return exports.orders_fact(tpch_orders(spark, sf_dir))


@query(
    "model_scores_fact",
    with_ctes(
        *RFM, sql.scores("hs", "r"), *COMPANY,
        select=f"""SELECT customer_id, strftime({sql.AS_OF}, '%Y-%m-%d') AS as_of_date, rfm_segment,
  least(frequency_365d, 5)::INTEGER AS kmeans_cluster, churn_probability AS churn_prob, duration_days, event_observed,
  (SELECT arg_min(model, rmse) FROM me) AS forecast_model_best, (SELECT arg_max(revenue, week_end) FROM w) AS weekly_revenue_last FROM hs""",
    ),
)
def q_model_scores_fact(spark, sf_dir):
    """With the heuristic score in place of a model's."""
    orders = tpch_orders(spark, sf_dir)
    as_of = latest_order_date(orders)
    weeks = materialize(weekly_series(orders))
    last_week = weeks.orderBy(F.desc("week_end")).first()["revenue"]
    best = best_model(forecast_metrics(baseline_forecasts(split_series(weeks)))).first()["model"]
    customers = add_rfm_segments(materialize(customer_features(orders, as_of)))
    scored = scored_now(banded(customers)).withColumnRenamed("churn_probability", "churn_prob")
    return exports.model_scores_fact(scored, None, as_of, best, last_week)


@query(
    "kpi_summary",
    with_ctes(
        *SCORED, *COMPANY, MONTE_CARLO, RANKING, OLS,
        select="""SELECT 'profit_regression_r2' AS kpi, round(any_value(r2), 6) AS value, NULL::VARCHAR AS text FROM ol
  UNION ALL SELECT 'simulated_profit_mean', round(mean_total_profit, 2), NULL FROM mc
  UNION ALL SELECT 'simulated_profit_p5', round(p5, 2), NULL FROM mc
  UNION ALL SELECT 'simulated_profit_p95', round(p95, 2), NULL FROM mc
  UNION ALL SELECT 'best_forecast_rmse', round(min(rmse), 2), arg_min(model, rmse) FROM me
  UNION ALL SELECT 'churn_auc_roc', round(auc, 6), 'heuristic' FROM rm""",
    ),
)
def q_kpi_summary(spark, sf_dir):
    """Key figures of one run, in long form."""
    orders = keyed_orders(spark, sf_dir)
    customers = materialize(features_of(orders))
    scored = scored_now(customers).select(
        F.lit("heuristic").alias("model"), F.col("churned").alias("label"), F.col("churn_probability").alias("prob")
    )
    return kpi_table(
        profit_drivers(customers), profit_of(orders), company_best_forecast(orders), leaderboard(ranking_metrics(scored))
    )


def kpi_table(drivers: DataFrame, profit: DataFrame, best_forecast: DataFrame, churn_metrics: DataFrame) -> DataFrame:
    """(kpi, value, text) rows from the result tables of a run."""
    row = lambda df, kpi, value, digits, text=F.lit(None): df.select(
        F.lit(kpi).alias("kpi"), F.round(value, digits).alias("value"), text.cast("string").alias("text")
    )
    return (
        row(drivers.where("term = 'const'"), "profit_regression_r2", "r2", 6)
        .unionByName(row(profit, "simulated_profit_mean", "mean_total_profit", 2))
        .unionByName(row(profit, "simulated_profit_p5", "p5", 2))
        .unionByName(row(profit, "simulated_profit_p95", "p95", 2))
        .unionByName(row(best_forecast, "best_forecast_rmse", "rmse", 2, F.col("model")))
        .unionByName(row(churn_metrics, "churn_auc_roc", "auc_roc", 6, F.col("model")))
    )
