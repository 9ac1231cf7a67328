"""Model registry: one Parquet table of versions beside the saved pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = (
    "name string, version string, path string, model_type string, metrics map<string,double>, "
    "hyperparams map<string,string>, dataset_hash string, created_at timestamp"
)


def dataset_fingerprint(df: DataFrame) -> str:
    """Hash of the row contents that does not depend on row order or partitioning."""
    row = F.xxhash64(*sorted(df.columns))
    parts = df.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(row.cast("decimal(20,0)")).alias("s")
    ).select(F.md5(F.concat_ws("|", "n", "x", "s")))
    return parts.first()[0]


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")


class ModelRegistry:
    """Append-only registry under ``root``; the latest version is the lexicographic maximum."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table_path = f"{self.root}/registry"

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.table_path)
        except AnalysisException:  # nothing registered yet
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)

    def register(
        self,
        name: str,
        version: str,
        path: str | None,
        model_type: str,
        metrics: dict[str, float] | None = None,
        hyperparams: dict | None = None,
        dataset_hash: str | None = None,
    ) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        row = (
            name, version, path, model_type, {k: float(v) for k, v in (metrics or {}).items()},
            {k: str(v) for k, v in (hyperparams or {}).items()}, dataset_hash, now,
        )
        self.spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(self.table_path)

    def save_model(self, model: PipelineModel, name: str, model_type: str, **facts) -> str:
        """Save a fitted pipeline and register it; returns the version."""
        version = new_version()
        path = f"{self.root}/models/{name}/{version}"
        model.write().save(path)
        self.register(name, version, path, model_type, **facts)
        return version

    def _entry(self, name: str, version: str):
        found = self.table().where(F.col("name") == name)
        if version != "latest":
            found = found.where(F.col("version") == version)
        row = found.orderBy(F.desc("version")).limit(1).collect()
        if not row:
            raise ValueError(f"no version {version!r} of model {name!r} in the registry")
        return row[0]

    def load(self, name: str, version: str = "latest") -> PipelineModel:
        return PipelineModel.load(self._entry(name, version)["path"])

    def get_metrics(self, name: str, version: str = "latest") -> dict[str, float]:
        return dict(self._entry(name, version)["metrics"])

    def list_models(self) -> list[str]:
        return [r[0] for r in self.table().select("name").distinct().orderBy("name").collect()]

    def list_versions(self, name: str) -> list[str]:
        rows = self.table().where(F.col("name") == name).select("version").distinct().orderBy("version")
        return [r[0] for r in rows.collect()]


def registry_summary(registry: DataFrame) -> DataFrame:
    """Versions, latest version and its metrics per model."""
    return registry.groupBy("name").agg(
        F.countDistinct("version").alias("total_versions"),
        F.max("version").alias("latest_version"),
        F.max_by("metrics", "version").alias("latest_metrics"),
    )


def metrics_map(*names: str) -> Column:
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])
