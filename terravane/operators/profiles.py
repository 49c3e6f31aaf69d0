"""Behaviour of flights: clusters of feature vectors and what each cluster seems to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ["altitude", "speed", "duration", "altitude_range", "hover", "linearity", "coverage", "coastal", "infrastructure"]


def clusters(vectors: DataFrame, k: int = 6, rounds: int = 100, seed: int = 1) -> DataFrame:
    """vectors (flight_id, callsign, the nine FEATURES) with cluster, by k-means with at most as many clusters as rows.

    A null feature counts as 0. Without rows there is no model and no row comes back.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    known = vectors.fillna(0.0, FEATURES)
    n = known.limit(k).count()
    if n < 2:
        return known.withColumn("cluster", F.lit(0))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)
    model = KMeans(k=min(k, n), maxIter=rounds, tol=0.0, seed=seed, featuresCol="features", predictionCol="cluster").fit(ready)
    return model.transform(ready).drop("features")


def describe(clustered: DataFrame) -> DataFrame:
    """A row for each cluster: size, number of callsigns, means, and the label that the means suggest."""
    means = [F.avg(c).alias(c) for c in ("altitude", "hover", "linearity", "coastal", "speed", "duration")]
    g = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.countDistinct("callsign").alias("n_callsigns"), *means)
    h, ln = F.col("hover"), F.col("linearity")
    label = (
        F.when((h > 0.5) & (ln < 0.4), "Search / Patrol Operations")
        .when((h > 0.4) & (F.col("altitude") < 0.3), "Power Line Inspection")
        .when((ln > 0.8) & (F.col("speed") > 0.6), "Emergency Transit")
        .when((F.col("coastal") > 0.7) & (ln > 0.5), "Maritime Patrol")
        .when((ln > 0.7) & (h < 0.1), "Charter / Point-to-Point")
        .otherwise("General / Unknown")
    )
    return g.withColumn("label", label)
