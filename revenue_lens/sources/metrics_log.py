"""Run metrics as JSON tables, one folder per topic, overwritten by each run."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_SCHEMA = "key string, value double, text string"


def metric_rows(spark: SparkSession, payload: dict[str, Any]) -> DataFrame:
    """A flat payload as (key, value, text); numbers go to value, the rest to text."""
    rows = [
        (k, float(v), None) if isinstance(v, (int, float)) and not isinstance(v, bool) else (k, None, None if v is None else str(v))
        for k, v in payload.items()
    ]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def write_metrics(table: DataFrame, root: str, topic: str) -> None:
    table.write.mode("overwrite").json(f"{root}/metrics/topic={topic}")


def latest_metrics(spark: SparkSession, root: str) -> DataFrame:
    """All topics together; the topic comes from the folder name."""
    return spark.read.json(f"{root}/metrics").withColumn("topic", F.col("topic").cast("string"))
