"""Standardising, k-means and the silhouette."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.operators.quantiles import scalar_row
from bayline.operators.silhouette import euclidean_silhouette
from bayline.sources.sinks import stage

# fixed values: columns of the first and of the refined clustering, restarts and seed
FEATURES_V1 = (
    "visit_count",
    "unique_vehicles",
    "avg_delay_hours",
    "delay_rate",
    "service_type_count",
    "recency_days",
)
FEATURES_V2 = (
    "visit_count",
    "unique_vehicles",
    "avg_delay_hours",
    "delay_rate",
    "avg_csat",
    "complaint_rate",
    "service_type_count",
    "recency_days",
)
CLUSTERS = 4
RESTARTS = 10
SEED = 42
PARALLEL_FITS = 5


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1; a constant column is only centred."""
    stats = scalar_row(
        df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in cols],
            *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols],
        )
    )

    def scaled(c: str) -> Column:
        sd = F.col("_scale")[f"sd_{c}"]
        centred = F.col(c) - F.col("_scale")[f"mean_{c}"]
        return centred / F.when(sd > 0, sd).otherwise(F.lit(1.0))

    return df.withColumn("_scale", stats).withColumns({c: scaled(c) for c in cols}).drop("_scale")


def _vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows with their standardised features as one vector."""
    scaled = [f"_scaled_{c}" for c in cols]
    rows = df.withColumns({s: F.col(c).cast("double") for s, c in zip(scaled, cols)})
    assembler = VectorAssembler(inputCols=scaled, outputCol="_features")
    return assembler.transform(standardize(rows, scaled)).drop(*scaled)


def _best_model(vectors: DataFrame, k: int, restarts: int):
    """The model with the lowest cost over several seeds, the runs side by side."""

    # of a table that is not cached itself, a run keeps its vectors as objects; else every pass would decode them twice
    features = vectors.select("_features")

    def fit(seed: int):
        means = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster_id")
        return means.fit(features)

    with ThreadPool(min(restarts, PARALLEL_FITS)) as pool:
        run = inheritable_thread_target(vectors.sparkSession)(fit)
        fits = pool.map(run, range(SEED, SEED + restarts))
    return min(fits, key=lambda model: model.summary.trainingCost)


def kmeans_fit(
    df: DataFrame, key: str, cols: Sequence[str], k: int = CLUSTERS, restarts: int = RESTARTS
) -> DataFrame:
    """The rows that have a key with their cluster, from the best of several k-means runs."""
    vectors = _vectors(df.filter(F.col(key).isNotNull()), cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        clustered = _best_model(vectors, k, restarts).transform(vectors)
        return stage(clustered.drop("_features"), "clustered")
    finally:
        vectors.unpersist()


def k_search(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    ks: Sequence[int],
    restarts: int = RESTARTS,
    distance: str = "squared",
    sample: float | None = None,
) -> DataFrame:
    """Silhouette per number of clusters and whether it is the best one.

    ``distance`` is "squared", whose cost is rows times clusters, or "euclidean", which meets all pairs of
    rows unless ``sample`` gives the share of rows to evaluate.
    """
    vectors = _vectors(df.select(key, *cols), cols).persist(StorageLevel.MEMORY_AND_DISK)
    evaluator = ClusteringEvaluator(featuresCol="_features", predictionCol="cluster_id")

    def score(clustered: DataFrame) -> float:
        if distance == "squared":
            return float(evaluator.evaluate(clustered))
        rows = clustered.select("cluster_id", vector_to_array("_features").alias("x"))
        return euclidean_silhouette(rows, "x", "cluster_id", sample).first()["silhouette_score"]

    if distance not in ("squared", "euclidean"):
        raise ValueError(f"unknown distance: {distance}")
    try:
        scores = [(k, score(_best_model(vectors, k, restarts).transform(vectors))) for k in ks]
    finally:
        vectors.unpersist()
    best = max(scores, key=lambda row: row[1])[0]
    return df.sparkSession.createDataFrame(
        [(k, score, k == best) for k, score in scores],
        "k int, silhouette_score double, best boolean",
    )


def silhouette(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Silhouette of given labels in squared Euclidean distance, one row.

    The mean squared distance of a point to all points of a cluster follows from three
    sums per cluster: its size, its vector sum and the sum of its squared norms. So the cost
    is rows times clusters, and no pair of rows is formed. A single-row cluster scores 0.
    """
    rows = df.select(
        F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_x")
    ).dropna()
    # distances do not depend on the origin; near the mean, the difference of norms keeps its digits
    mean = rows.agg(vector_to_array(Summarizer.mean(array_to_vector("_x")))).scalar()
    rows = rows.withColumn("_mean", mean).withColumn(
        "_x", F.zip_with("_x", "_mean", lambda v, m: v - m)
    ).drop("_mean")
    norm = F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v)
    rows = rows.withColumn("_norm", norm)
    # one entry per cluster: labels are few, like the k of a clustering
    clusters = (
        rows.groupBy(F.col("_label").alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("_norm").alias("norms"),
            vector_to_array(Summarizer.sum(array_to_vector("_x"))).alias("sum"),
        )
        .agg(F.collect_list(F.struct("label", "n", "norms", "sum")))
        .scalar()
    )

    def total_to(cluster: Column) -> Column:
        dot = F.aggregate(
            F.zip_with("_x", cluster["sum"], lambda a, b: a * b),
            F.lit(0.0),
            lambda acc, v: acc + v,
        )
        total = cluster["n"] * F.col("_norm") + cluster["norms"] - F.lit(2.0) * dot
        return F.greatest(total, F.lit(0.0))

    distances = F.transform(
        F.col("_clusters"),
        lambda c: F.struct(
            (c["label"] == F.col("_label")).alias("own"),
            c["n"].alias("n"),
            total_to(c).alias("total"),
        ),
    )
    own = F.filter("_d", lambda d: d["own"])[0]
    others = F.filter("_d", lambda d: ~d["own"])
    inner = F.try_divide(own["total"], (own["n"] - 1).cast("double"))
    outer = F.array_min(F.transform(others, lambda d: d["total"] / d["n"]))
    score = F.when(own["n"] == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    )
    return (
        rows.withColumn("_clusters", clusters)
        .withColumn("_d", distances)
        .withColumns({"_a": inner, "_b": outer})
        .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("silhouette_score"))
    )
