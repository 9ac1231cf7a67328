"""Behavioural clusters and their comparison with the RFM segments."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.operators.lloyd import Centres, k_means
from revenue_lens.operators.rfm import SEGMENTS
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import BEHAVIOUR_FEATURES, SEED

CLUSTER = "kmeans_cluster"
MISSING_CLUSTER = -1


def standardised(customers: DataFrame, features: list[str] = BEHAVIOUR_FEATURES) -> DataFrame:
    """Complete rows with the standardised feature vector ``x``."""
    rows = customers.na.drop(subset=features)
    raw = VectorAssembler(inputCols=features, outputCol="x_raw").transform(rows)
    scaler = StandardScaler(inputCol="x_raw", outputCol="x", withMean=True, withStd=True)
    return scaler.fit(raw).transform(raw).drop("x_raw")


def silhouette(df: DataFrame, label: str = CLUSTER) -> float | None:
    """Mean silhouette with squared Euclidean distance, linear in the rows; NULL for one cluster."""
    if df.select(label).distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(featuresCol="x", predictionCol=label, metricName="silhouette").evaluate(df)


def kmeans_by_k(points: DataFrame, k_min: int = 3, k_max: int = 8, seed: int = SEED, n_init: int = 10) -> dict[int, tuple[Centres, float | None]]:
    """{k: (best model of n_init starts, silhouette)}; k not below the row count is skipped. All starts of all k take their
    steps in the same jobs."""
    rows = points.count()
    starts = {k: n_init for k in range(k_min, k_max + 1) if k < rows}
    models = k_means(points, starts, seed) if starts else {}
    return {k: (m, silhouette(m.transform(points, cluster=CLUSTER))) for k, m in sorted(models.items())}


def kmeans_segmentation(
    customers: DataFrame, features: list[str] = BEHAVIOUR_FEATURES, k_min: int = 3, k_max: int = 8, seed: int = SEED, n_init: int = 10
) -> tuple[DataFrame, dict]:
    """Customers with ``kmeans_cluster`` (-1 where a feature is missing) and the choice of k."""
    points = materialize(standardised(customers, features))
    found = kmeans_by_k(points, k_min, k_max, seed, n_init)
    scores = {k: -1.0 if s is None else s for k, (_, s) in found.items()}
    if not scores:
        return customers.withColumn(CLUSTER, F.lit(MISSING_CLUSTER)), {"best_k": k_min, "silhouette_by_k": {}}
    best_k = max(scores, key=lambda k: (scores[k], -k))
    clustered = found[best_k][0].transform(points, cluster=CLUSTER).drop("x")
    incomplete = customers.where(" OR ".join(f"{c} IS NULL" for c in features)).withColumn(CLUSTER, F.lit(MISSING_CLUSTER))
    meta = {"best_k": best_k, "silhouette_by_k": scores, "silhouette_chosen": scores[best_k]}
    return clustered.unionByName(incomplete), meta


def cluster_segment_crosstab(customers: DataFrame, cluster: str = CLUSTER, segments: list[str] = SEGMENTS) -> DataFrame:
    """Share of each RFM segment per cluster, one column per segment, rows summing to 1."""
    counts = customers.na.drop(subset=["rfm_segment", cluster]).groupBy(cluster, "rfm_segment").agg(F.count(F.lit(1)).alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(cluster)))
    return shares.groupBy(cluster).pivot("rfm_segment", segments).agg(F.first("share")).na.fill(0.0, subset=segments)
