from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def many_blocks(spark):
    """Keep every shuffle partition, so that small inputs still span several blocks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture()
def make_orders(spark):
    def make(rows):
        """rows of (customer, day text, revenue)"""
        from revenue_lens.sources.orders import ORDERS_SCHEMA

        return spark.createDataFrame([(c, day(d), float(r), "A") for c, d, r in rows], ORDERS_SCHEMA)

    return make
