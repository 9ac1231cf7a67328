"""Common table expressions shared by the checking SQL (DuckDB dialect)."""

from __future__ import annotations

O = """o AS (
  SELECT o_orderkey::BIGINT AS order_id, o_custkey::BIGINT AS customer_id, o_orderdate::DATE AS order_date,
         o_totalprice::DOUBLE AS revenue, o_orderpriority AS category
  FROM orders)"""

AS_OF = "(SELECT max(order_date) FROM o)"

NATION_ORDERS = """no AS (
  SELECT n_name AS series_key, o_orderdate::DATE AS order_date, o_totalprice AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


SEGMENT_ORDERS = """so AS (
  SELECT c_mktsegment AS series_key, o_orderdate::DATE AS order_date, o_totalprice AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def snapshot(name: str, as_of: str) -> str:
    """Customer snapshot at ``as_of`` from table o, with the mean gap taken from real gaps."""
    return f"""{name}_past AS (SELECT *, {as_of} AS as_of FROM o WHERE order_date <= {as_of}),
{name}_gaps AS (
  SELECT customer_id, avg(gap) AS gap FROM (
    SELECT customer_id, (order_date - lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date)) AS gap
    FROM {name}_past) GROUP BY customer_id),
{name}_sums AS (
  SELECT customer_id, any_value(as_of) AS as_of, min(order_date) AS first_purchase, max(order_date) AS last_purchase,
         count(*) FILTER (order_date > as_of - 365) AS frequency_365d,
         coalesce(sum(revenue::DECIMAL(18,2)) FILTER (order_date > as_of - 365), 0)::DOUBLE AS monetary_365d,
         sum(revenue::DECIMAL(18,2))::DOUBLE AS monetary_all
  FROM {name}_past GROUP BY customer_id),
{name} AS (
  SELECT s.customer_id, s.as_of, first_purchase, last_purchase, frequency_365d::BIGINT AS frequency_365d,
         monetary_365d, monetary_all, (s.as_of - last_purchase)::BIGINT AS recency_days,
         (last_purchase - first_purchase)::BIGINT AS tenure_days, coalesce(gap, 0.0)::DOUBLE AS avg_interpurchase_days,
         monetary_365d * (frequency_365d + 1) / ((s.as_of - last_purchase) + 1) AS clv_proxy
  FROM {name}_sums s LEFT JOIN {name}_gaps USING (customer_id))"""


def features(name: str, as_of: str) -> str:
    """Snapshot at ``as_of`` and 60 days before, labels and survival columns."""
    return f"""{snapshot(name + '_now', as_of)},
{snapshot(name + '_lag', f'({as_of} - 60)')},
{name} AS (
  SELECT n.*, (n.recency_days > 90)::INTEGER AS churned,
         coalesce(l.frequency_365d, 0)::DOUBLE AS lag_frequency_365d,
         coalesce(l.monetary_365d, 0)::DOUBLE AS lag_monetary_365d,
         coalesce(l.tenure_days, 0)::DOUBLE AS lag_tenure_days,
         coalesce(l.avg_interpurchase_days, 0)::DOUBLE AS lag_avg_interpurchase_days,
         coalesce(l.clv_proxy, 0)::DOUBLE AS lag_clv_proxy,
         greatest(CASE WHEN n.recency_days > 90 THEN n.last_purchase + 90 - n.first_purchase
                       ELSE n.as_of - n.first_purchase END, 1)::INTEGER AS duration_days,
         (n.recency_days > 90)::INTEGER AS event_observed
  FROM {name}_now n LEFT JOIN {name}_lag l USING (customer_id))"""


def rfm(name: str, source: str) -> str:
    """RFM scores and segment of a feature table."""
    return f"""{name}_q AS (
  SELECT *,
    6 - ((5 * row_number() OVER (ORDER BY recency_days, customer_id) + count(*) OVER () - 1) // count(*) OVER ())::INTEGER AS R_score,
    ((5 * row_number() OVER (ORDER BY frequency_365d, customer_id) + count(*) OVER () - 1) // count(*) OVER ())::INTEGER AS F_score,
    ((5 * row_number() OVER (ORDER BY monetary_365d, customer_id) + count(*) OVER () - 1) // count(*) OVER ())::INTEGER AS M_score
  FROM {source}),
{name} AS (
  SELECT *, R_score::VARCHAR || F_score::VARCHAR || M_score::VARCHAR AS rfm_score,
    CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'champions'
         WHEN R_score >= 3 AND F_score >= 3 THEN 'loyal'
         WHEN R_score >= 4 AND F_score <= 2 THEN 'new_or_promising'
         WHEN R_score <= 2 AND F_score >= 3 THEN 'at_risk'
         WHEN R_score <= 2 AND F_score <= 2 THEN 'hibernating'
         ELSE 'other' END AS rfm_segment
  FROM {name}_q)"""


def scores(name: str, source: str) -> str:
    """Heuristic churn probability, rounded to 4 places, and the risk tier."""
    return f"""{name} AS (
  SELECT *, round(p, 4) AS churn_probability,
         CASE WHEN p > 0.6::DOUBLE THEN 'High' WHEN p > 0.3::DOUBLE THEN 'Medium' ELSE 'Low' END AS risk_tier
  FROM (SELECT *, 1 / (1 + exp(-(0.004::DOUBLE * recency_days - 0.02::DOUBLE * frequency_365d
                                 - 0.0001::DOUBLE * monetary_365d + 0.001::DOUBLE * tenure_days))) AS p
        FROM {source}))"""


def weekly(name: str, source: str, key: str | None = None) -> str:
    """Zero-filled weekly revenue; one series per ``key`` or one in all."""
    k = f"{key} AS series_key" if key else "'all' AS series_key"
    return f"""{name}_days AS (
  SELECT {k}, order_date, (order_date + ((8 - isodow(order_date)) % 7)::INTEGER)::DATE AS week_end,
         revenue::DECIMAL(18,2) AS amount FROM {source}),
{name}_sums AS (
  SELECT series_key, week_end, sum(amount)::DOUBLE AS revenue, min(order_date) AS d0, max(order_date) AS d1
  FROM {name}_days GROUP BY ALL),
{name}_spine AS (
  SELECT series_key, unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY))::DATE AS week_end,
         min(week_end) AS w0, max(week_end) AS w1 FROM {name}_sums GROUP BY series_key),
{name} AS (
  SELECT series_key, week_end, coalesce(revenue, 0.0)::DOUBLE AS revenue,
         coalesce((week_end = w0 AND d0 > week_end - 6) OR (week_end = w1 AND d1 < week_end), false) AS is_partial
  FROM {name}_spine LEFT JOIN {name}_sums USING (series_key, week_end))"""
