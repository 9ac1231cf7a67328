from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.functions import heuristic_probability, risk_tier
from revenue_lens.operators.cohorts import COHORTS, PERIODS, cohort_retention, cohort_retention_table
from revenue_lens.operators.customers import customer_features, customer_features_at, purchase_gaps
from revenue_lens.operators.rfm import add_rfm_segments, segment_profile, top_risk_decile
from revenue_lens.operators.storage import materialize, shared_folder
from revenue_lens.operators.weekly import weekly_revenue
from revenue_lens.plans import sql_parts as sql
from revenue_lens.plans.catalog import query, with_ctes
from revenue_lens.sources.orders import latest_order_date, orders_by_nation, purchases, tpch_orders
from revenue_lens.streaming.customer_state import CustomerState


def features_of(orders: DataFrame) -> DataFrame:
    """Customer features at the last order date."""
    return customer_features(orders, latest_order_date(orders))


def features_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written once, for queries that read them several times."""
    return materialize(features_of(tpch_orders(spark, sf_dir)))


def rfm_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_rfm_segments(features_now(spark, sf_dir))


def scored_now(customers: DataFrame) -> DataFrame:
    """Heuristic probability (4 places, as served) and tier (from the unrounded value)."""
    p = heuristic_probability()
    return customers.withColumns({"churn_probability": F.round(p, 4), "risk_tier": risk_tier(p)})


FEATURE_COLUMNS = """customer_id, first_purchase, last_purchase, frequency_365d, monetary_365d, monetary_all,
  recency_days, tenure_days, avg_interpurchase_days, clv_proxy, churned, lag_frequency_365d, lag_monetary_365d,
  lag_tenure_days, lag_avg_interpurchase_days, lag_clv_proxy, duration_days, event_observed"""


@query(
    "weekly_revenue",
    with_ctes(sql.O, sql.weekly("w", "o"), select="SELECT week_end, revenue, is_partial FROM w"),
)
def q_weekly_revenue(spark, sf_dir):
    return weekly_revenue(tpch_orders(spark, sf_dir))


@query(
    "weekly_revenue_by_nation",
    with_ctes(sql.NATION_ORDERS, sql.weekly("w", "no", "series_key"), select="SELECT series_key, week_end, revenue, is_partial FROM w"),
)
def q_weekly_by_nation(spark, sf_dir):
    return weekly_revenue(orders_by_nation(spark, sf_dir), ["series_key"])


@query(
    "weekly_purchases",
    with_ctes(
        "p AS (SELECT ts::DATE AS order_date, value AS revenue FROM events WHERE event_type = 'purchase')",
        sql.weekly("w", "p"),
        select="SELECT week_end, revenue, is_partial FROM w",
    ),
)
def q_weekly_purchases(spark, sf_dir):
    return weekly_revenue(purchases(spark.read.parquet(f"{sf_dir}/events.parquet")))


@query("customer_features", with_ctes(sql.O, sql.features("f", sql.AS_OF), select=f"SELECT {FEATURE_COLUMNS} FROM f"))
def q_customer_features(spark, sf_dir):
    return features_of(tpch_orders(spark, sf_dir))


@query("customer_features_incremental", with_ctes(sql.O, sql.features("f", sql.AS_OF), select=f"SELECT {FEATURE_COLUMNS} FROM f"))
def q_customer_features_incremental(spark, sf_dir):
    """The features after the orders arrived in five batches, in no order of time, with a merge after every second one."""
    orders = tpch_orders(spark, sf_dir)
    last = latest_order_date(orders)
    state = CustomerState(spark, f"{shared_folder(spark)}/customer_state/{uuid.uuid4().hex}")
    write = state.writer()
    for number in range(5):
        write(orders.where(F.pmod(F.xxhash64("customer_id", "order_date", "revenue"), F.lit(5)) == number), number)
        if number % 2:
            state.merge(last)
    return state.features(last)


def _yearly(last: dt.date) -> list[dt.date]:
    return [last - dt.timedelta(days=365 * i) for i in range(6)]


@query(
    "customer_features_multi_asof",
    with_ctes(
        sql.O,
        *[sql.features(f"f{i}", f"({sql.AS_OF} - {365 * i})") for i in range(6)],
        select=" UNION ALL ".join(f"SELECT as_of AS as_of_date, {FEATURE_COLUMNS} FROM f{i}" for i in range(6)),
    ),
)
def q_customer_features_multi_asof(spark, sf_dir):
    orders = tpch_orders(spark, sf_dir)
    return customer_features_at(orders, _yearly(latest_order_date(orders)))


@query(
    "purchase_gaps",
    with_ctes(
        sql.O,
        select="""SELECT customer_id, order_date, orders, gap::BIGINT AS gap_days FROM (
  SELECT customer_id, order_date, count(*) OVER (PARTITION BY customer_id, order_date) AS orders,
         order_date - lag(order_date) OVER w AS gap, row_number() OVER (PARTITION BY customer_id, order_date ORDER BY order_id) AS rn
  FROM o WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)) WHERE rn = 1""",
    ),
)
def q_purchase_gaps(spark, sf_dir):
    return purchase_gaps(tpch_orders(spark, sf_dir))


@query(
    "rfm_segments",
    with_ctes(
        sql.O,
        sql.features("f", sql.AS_OF),
        sql.rfm("r", "f"),
        select="""SELECT customer_id, recency_days, frequency_365d, monetary_365d, R_score, F_score, M_score,
  rfm_score, rfm_segment FROM r""",
    ),
)
def q_rfm_segments(spark, sf_dir):
    return rfm_now(spark, sf_dir).select(
        "customer_id", "recency_days", "frequency_365d", "monetary_365d",
        "R_score", "F_score", "M_score", "rfm_score", "rfm_segment",
    )


@query(
    "rfm_segment_profile",
    with_ctes(
        sql.O,
        sql.features("f", sql.AS_OF),
        sql.rfm("r", "f"),
        select="""SELECT rfm_segment, count(*) AS customers, sum(monetary_365d::DECIMAL(18,2))::DOUBLE AS revenue_365d,
  avg(churned)::DOUBLE AS churn_rate FROM r GROUP BY rfm_segment""",
    ),
)
def q_rfm_segment_profile(spark, sf_dir):
    return segment_profile(rfm_now(spark, sf_dir))


@query(
    "top_risk_decile",
    with_ctes(
        sql.O,
        sql.features("f", sql.AS_OF),
        sql.scores("s", "f"),
        select="""SELECT customer_id, churn_probability, risk_tier, 10 AS risk_decile FROM (
  SELECT *, row_number() OVER (ORDER BY churn_probability, customer_id) AS rn, count(*) OVER () AS n FROM s)
  WHERE (10 * rn + n - 1) // n = 10""",
    ),
)
def q_top_risk_decile(spark, sf_dir):
    customers = features_now(spark, sf_dir)
    return top_risk_decile(scored_now(customers)).select("customer_id", "churn_probability", "risk_tier", "risk_decile")


def _cohort_ctes(cohorts: str = "", periods: str = "") -> str:
    return f"""m AS (SELECT DISTINCT customer_id, date_trunc('month', order_date)::DATE AS month FROM o WHERE order_date <= {sql.AS_OF}),
c AS (SELECT customer_id, min(month) AS cohort FROM m GROUP BY customer_id),
a AS (SELECT cohort, ((year(month) - year(cohort)) * 12 + month(month) - month(cohort))::BIGINT AS period_index,
             count(DISTINCT customer_id) AS active FROM m JOIN c USING (customer_id) GROUP BY ALL),
z AS (SELECT cohort, count(*) AS cohort_size FROM c GROUP BY cohort ORDER BY cohort {cohorts}),
i AS (SELECT DISTINCT period_index FROM a ORDER BY period_index {periods}),
r AS (SELECT cohort, period_index, cohort_size, coalesce(active, 0)::BIGINT AS active,
             coalesce(active, 0)::DOUBLE / cohort_size AS retention,
             (cohort + to_months(period_index::INTEGER))::DATE <= {sql.AS_OF} AS is_observable
      FROM z CROSS JOIN i LEFT JOIN a USING (cohort, period_index))"""


@query("cohort_retention_long", with_ctes(sql.O, _cohort_ctes(), select="SELECT * FROM r"))
def q_cohort_long(spark, sf_dir):
    orders = tpch_orders(spark, sf_dir)
    return cohort_retention(orders, latest_order_date(orders))


@query(
    "cohort_retention_wide",
    with_ctes(
        sql.O,
        _cohort_ctes(f"LIMIT {COHORTS}", f"LIMIT {PERIODS}"),
        select="SELECT cohort, "
        + ", ".join(f"max(retention) FILTER (period_index = {i}) AS m{i}" for i in range(PERIODS))
        + " FROM r GROUP BY cohort",
    ),
)
def q_cohort_wide(spark, sf_dir):
    """The presentation table; the whole of it is `cohort_retention_long`."""
    orders = tpch_orders(spark, sf_dir)
    return cohort_retention_table(orders, latest_order_date(orders), COHORTS, PERIODS)
