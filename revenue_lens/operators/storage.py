"""Written intermediate tables: they cut lineage and survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revenue_lens_"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it where several jobs read the same result, or where a later step relies on
    row placement that a recomputation could change.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/revenue_lens/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
