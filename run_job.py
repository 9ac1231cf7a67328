"""spark-submit run_job.py ORDERS OUT_DIR [--format csv] [--order-key ID] [--as-of 2024-03-01] [--baseline TABLE_PATH]
[--option header=true ...]: the whole run on one orders table."""

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from revenue_lens.plans.job import run
from revenue_lens.sources.orders import read_orders

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("orders")
    parser.add_argument("out_dir")
    parser.add_argument("--format", default="parquet", help="parquet, orc, csv, json or table")
    parser.add_argument("--order-key", help="unique column that seeds the simulated draws")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="observation day; the last order's without it")
    parser.add_argument("--baseline", help="Parquet folder of an earlier customer table for the drift check")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("revenue_lens").getOrCreate()
    options = dict(o.split("=", 1) for o in given.option)
    orders = read_orders(spark, given.orders, given.format, keep=[given.order_key] if given.order_key else None, **options)
    baseline = spark.read.parquet(given.baseline) if given.baseline else None
    run(orders, given.out_dir, given.as_of, given.order_key, baseline)
