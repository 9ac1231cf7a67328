"""The one input of the library: orders(customer_id, order_date, revenue, category)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("category", T.StringType()),
    ]
)


def as_orders(df: DataFrame, columns: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Bind any frame to the orders schema.

    ``columns`` maps our names to those of ``df``; ``keep`` passes further columns
    through. Text dates that do not parse become NULL instead of failing the job.
    """
    names = {f.name: f.name for f in ORDERS_SCHEMA} | (columns or {})
    day = F.col(names["order_date"])
    if isinstance(df.schema[names["order_date"]].dataType, T.StringType):
        day = F.try_to_timestamp(day)
    return df.select(
        F.col(names["customer_id"]).cast("bigint").alias("customer_id"),
        F.to_date(day).alias("order_date"),
        F.col(names["revenue"]).cast("double").alias("revenue"),
        F.col(names["category"]).cast("string").alias("category"),
        *(keep or []),
    )


def read_orders(
    spark: SparkSession,
    location: str,
    source: str = "parquet",
    columns: dict[str, str] | None = None,
    keep: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """Orders from Parquet, ORC, CSV, JSON or a catalog table (``source="table"``); ``keep`` passes further columns."""
    if source == "table":
        return as_orders(spark.table(location), columns, keep)
    reader = spark.read.format(source).options(**options)
    if source == "csv":
        reader = reader.option("header", options.get("header", "true"))
    return as_orders(reader.load(location), columns, keep)


def tpch_orders(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """`orders` of a TPC-H-like folder."""
    return as_orders(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        {
            "customer_id": "o_custkey",
            "order_date": "o_orderdate",
            "revenue": "o_totalprice",
            "category": "o_orderpriority",
        },
        keep,
    )


def orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``series_key`` = the customer's nation.

    No hints: Spark picks each join from the size of the dimension files.
    """
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_name").alias("series_key"))
    return (
        tpch_orders(spark, sf_dir)
        .join(customer, F.col("customer_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("series_key", "customer_id", "order_date", "revenue", "category")
    )


def orders_by_market_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``series_key`` = the customer's market segment."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("series_key"))
    return (
        tpch_orders(spark, sf_dir)
        .join(customer, F.col("customer_id") == F.col("c_custkey"))
        .select("series_key", "customer_id", "order_date", "revenue", "category")
    )


def purchases(events: DataFrame) -> DataFrame:
    """Purchase events as orders; works on a batch and on a stream."""
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.to_date("ts").alias("order_date"),
        F.col("value").cast("double").alias("revenue"),
        F.col("event_type").alias("category"),
    )


def latest_order_date(orders: DataFrame) -> dt.date:
    """The default observation date: the day of the last order."""
    return orders.agg(F.max("order_date")).first()[0]


# Smallest value a scoring request may carry.
REQUEST_MINIMA = {
    "customer_id": 1,
    "recency_days": 0,
    "frequency_365d": 0,
    "monetary_365d": 0,
    "tenure_days": 0,
    "avg_interpurchase_days": 0,
    "clv_proxy": 0,
}


def with_reject_reason(requests: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the failing fields, or NULL for a valid request."""
    problems = [
        F.when(F.col(c).isNull(), f"{c} is missing").when(F.col(c) < low, f"{c} < {low}")
        for c, low in REQUEST_MINIMA.items()
    ]
    return requests.withColumn("reject_reason", F.nullif(F.concat_ws("; ", *problems), F.lit("")))


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid requests, rejected requests with the reason)."""
    checked = with_reject_reason(requests)
    return (
        checked.where("reject_reason IS NULL").drop("reject_reason"),
        checked.where("reject_reason IS NOT NULL"),
    )
