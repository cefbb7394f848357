"""K-means, cluster quality, cluster keywords and the cluster report."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from msgrisk.constants import CLUSTER_NAME, N_RESTARTS, SEED, TOP_KEYWORDS
from msgrisk.functions.arrays import bound, squared_distance
from msgrisk.operators.pairwise import silhouettes
from msgrisk.operators.sampling import cluster_examples
from msgrisk.session import materialised


# Fits that run side by side.
CONCURRENT_FITS = 8


def _array(df: DataFrame, vector: str) -> Column:
    return vector_to_array(vector) if isinstance(df.schema[vector].dataType, VectorUDT) else F.col(vector)


def _vector(df: DataFrame, vector: str) -> Column:
    return F.col(vector) if isinstance(df.schema[vector].dataType, VectorUDT) else array_to_vector(vector)


# --- source rows and k -------------------------------------------------------------------------

def fraud_rows(df: DataFrame, label: str = "y") -> DataFrame:
    return df.filter(F.col(label) == 1)


def cluster_source(df: DataFrame, label: str = "y") -> DataFrame:
    """Fraud rows, or all rows where there are none; decided inside the plan."""
    any_fraud = df.agg(F.coalesce(F.max(F.col(label) == 1), F.lit(False))).scalar()
    return df.filter((F.col(label) == 1) | ~any_fraud)


def effective_k(wanted: int, n_rows: int) -> int:
    return min(wanted, max(2, n_rows - 1))


# --- fitting -----------------------------------------------------------------------------------

def fit_kmeans_many(
    df: DataFrame, k_values: Sequence[int], features: str = "features", restarts: int = N_RESTARTS, seed: int = SEED
) -> dict[int, KMeansModel]:
    """For each k the model of lowest cost over restarts with different seeds. Persist df before.

    Fits run side by side, so that the short jobs of one fill the gaps of another.
    """
    def one(task):
        k, restart = task
        model = KMeans(k=k, featuresCol=features, predictionCol="cluster_id", seed=seed + restart).fit(df)
        return model.summary.trainingCost, restart, model

    tasks = [(k, i) for k in k_values for i in range(restarts)]
    if not tasks:
        return {}
    run = inheritable_thread_target(df.sparkSession)(one)
    with ThreadPool(min(len(tasks), CONCURRENT_FITS)) as pool:
        fits = pool.map(run, tasks, chunksize=1)
    found = {}
    for (k, _), fit in zip(tasks, fits):
        found.setdefault(k, []).append(fit)
    return {k: min(options, key=lambda f: f[:2])[2] for k, options in found.items()}


def fit_kmeans(
    df: DataFrame, k: int, features: str = "features", restarts: int = N_RESTARTS, seed: int = SEED
) -> KMeansModel:
    return fit_kmeans_many(df, [k], features, restarts, seed)[k]


def centre_table(model: KMeansModel, spark) -> DataFrame:
    """(cluster_id, centre): k rows."""
    return spark.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster_id int, centre array<double>",
    )


def sweep_values(k_values: Sequence[int], n_rows: int) -> list[int]:
    """The k that have more rows than clusters."""
    return [k for k in k_values if n_rows > k]


def k_sweep(
    df: DataFrame, models: dict[int, KMeansModel], key: str = "msg_id", features: str = "features", exact: bool = False
) -> DataFrame:
    """(k, inertia, silhouette) of fitted models.

    Silhouettes are by squared distance, in linear time. With exact=True they are Euclidean over all pairs of
    rows, which is quadratic; all k then share one pass over the distances.
    """
    costs = [(k, f"k{k}", float(m.summary.trainingCost)) for k, m in sorted(models.items())]
    table = df.sparkSession.createDataFrame(costs, "k int, clustering string, inertia double")
    if not costs:
        return table.select("k", "inertia", F.lit(None).cast("double").alias("silhouette"))
    if not exact:
        measured = [
            (name, ClusteringEvaluator(predictionCol="cluster_id", featuresCol=features).evaluate(models[k].transform(df)))
            for k, name, _ in costs
        ]
        scores = df.sparkSession.createDataFrame(measured, "clustering string, silhouette double")
        return table.join(F.broadcast(scores), "clustering").select("k", "inertia", "silhouette")
    assigned = df.select(key, features)
    for k, name, _ in costs:
        assigned = models[k].transform(assigned).withColumnRenamed("cluster_id", name)
    scores = silhouettes(assigned, key, features, [name for _, name, _ in costs])
    return table.join(scores, "clustering").select("k", "inertia", "silhouette")


def assign_clusters(df: DataFrame, centres: DataFrame, vector: str = "features") -> DataFrame:
    """Append the nearest centre's cluster_id; equal distances go to the lower id.

    centres is (cluster_id, centre) with k rows, read as one scalar, so rows stay where they are.
    """
    every = centres.agg(F.collect_list(F.struct("cluster_id", "centre"))).scalar()
    def options(x):
        return F.transform(
            "_every", lambda c: F.struct(squared_distance(x, c["centre"]).alias("d"), c["cluster_id"].alias("id"))
        )

    nearest = bound(_array(df, vector), lambda x: F.array_min(options(x))["id"])
    return df.withColumn("_every", every).withColumn("cluster_id", nearest).drop("_every")


# --- quality -----------------------------------------------------------------------------------

def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def centroids(df: DataFrame, cluster: str = "cluster_id", vector: str = "features") -> DataFrame:
    """(cluster, n, centroid). Partial means per task, k rows after the shuffle."""
    means = df.select(cluster, _vector(df, vector).alias("_v")).groupBy(cluster).agg(
        F.count("*").alias("n"), Summarizer.mean(F.col("_v")).alias("_mean")
    )
    return means.select(cluster, "n", vector_to_array("_mean").alias("centroid"))


def dispersion(df: DataFrame, cluster: str = "cluster_id", vector: str = "features") -> DataFrame:
    """(cluster, n, centroid, spread, within): mean distance and sum of squares to the centroid."""
    middle = centroids(df, cluster, vector)
    squared = squared_distance(F.col("_x"), F.col("centroid"))
    measured = (
        df.select(cluster, _array(df, vector).alias("_x"))
        .join(F.broadcast(middle.select(cluster, "centroid")), cluster)
        .select(cluster, squared.alias("_d2"))
        .groupBy(cluster).agg(F.avg(F.sqrt("_d2")).alias("spread"), F.sum("_d2").alias("within"))
    )
    return middle.join(measured, cluster)


def davies_bouldin(spread: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """One row (value) from the k rows of dispersion."""
    every = spread.agg(F.collect_list(F.struct(
        F.col(cluster).alias("id"), F.col("centroid").alias("c"), F.col("spread").alias("s")
    ))).scalar()
    worst = F.array_max(F.transform(
        F.filter("_every", lambda o: o["id"] != F.col(cluster)),
        lambda o: F.coalesce(
            (F.col("spread") + o["s"])
            / F.nullif(F.sqrt(squared_distance(F.col("centroid"), o["c"])), F.lit(0.0)),
            F.lit(0.0),
        ),
    ))
    return spread.withColumn("_every", every).select(worst.alias("worst")).agg(F.avg("worst").alias("value"))


def calinski_harabasz(spread: DataFrame) -> DataFrame:
    """One row (value) from the k rows of dispersion: between over within dispersion."""
    weighted = F.transform("centroid", lambda v: v * F.col("n"))
    add = lambda total, row: F.zip_with(total, row, lambda a, b: a + b)
    rows = spread.agg(F.collect_list(weighted), F.sum("n"), F.count("*"), F.sum("within")).toDF("w", "n", "k", "within")
    total = F.aggregate(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), F.get("w", F.lit(0)), add)
    mean = rows.select(F.transform(total, lambda v: v / F.col("n"))).scalar()
    apart = squared_distance(F.col("centroid"), F.col("_mean"))
    between = spread.withColumn("_mean", mean).agg(F.sum(F.col("n") * apart)).scalar()
    value = between * (F.col("n") - F.col("k")) / (F.nullif(F.col("within"), F.lit(0.0)) * (F.col("k") - 1))
    return rows.select(F.coalesce(value, F.lit(1.0)).alias("value"))


def silhouette_exact(df: DataFrame, key: str, cluster: str = "cluster_id", vector: str = "features") -> DataFrame:
    """One row (value): mean Euclidean silhouette over all rows."""
    return silhouettes(df, key, vector, [cluster]).select(F.col("silhouette").alias("value"))


def silhouette_fast(df: DataFrame, cluster: str = "cluster_id", vector: str = "features") -> DataFrame:
    """One row (value): mean silhouette by squared distance, in linear time."""
    rows = df.select(F.col(cluster).cast("int").alias("c"), _vector(df, vector).alias("v"))
    value = ClusteringEvaluator(predictionCol="c", featuresCol="v").evaluate(rows)
    return df.sparkSession.createDataFrame([(value,)], "value double")


def inertia(df: DataFrame, centres: DataFrame, cluster: str = "cluster_id", vector: str = "features") -> DataFrame:
    """One row (value): sum of squared distances to the assigned centres."""
    joined = df.select(cluster, _array(df, vector).alias("_x")).join(F.broadcast(centres), cluster)
    return joined.agg(F.sum(squared_distance(F.col("_x"), F.col("centre"))).alias("value"))


def cluster_quality(
    df: DataFrame,
    training_cost: Column,
    key: str = "msg_id",
    cluster: str = "cluster_id",
    vector: str = "features",
    exact: bool = False,
) -> DataFrame:
    """(metric, value) of the report over all rows, rounded to 4.

    The silhouette is by squared distance, in linear time; with exact=True it is Euclidean over all pairs. The
    k rows of dispersion are written once and feed both other measures.
    """
    rows = df.select(key, cluster, vector)
    spread = materialised(dispersion(rows, cluster, vector), "dispersion")
    parts = {
        "silhouette": silhouette_exact(rows, key, cluster, vector) if exact else silhouette_fast(rows, cluster, vector),
        "davies_bouldin": davies_bouldin(spread, cluster),
        "calinski_harabasz": calinski_harabasz(spread),
    }
    cost = df.sparkSession.range(1).select(training_cost.cast("double").alias("value"))
    rows = [t.select(F.lit(m).alias("metric"), F.round("value", 4).alias("value"))
            for m, t in {**parts, "inertia": cost}.items()]
    result, *rest = rows
    for row in rest:
        result = result.unionByName(row)
    return result


# --- description -------------------------------------------------------------------------------

def cluster_risk(df: DataFrame, cluster: str = "cluster_id", label: str = "y") -> DataFrame:
    """(cluster_id, cluster_risk): mean label."""
    return df.groupBy(cluster).agg(F.avg(label).alias("cluster_risk"))


def mean_term_weights(df: DataFrame, names: DataFrame, vector: str = "tfidf", cluster: str = "cluster_id") -> DataFrame:
    """(cluster, term, weight): the centre of each cluster in long form, without its zeros.

    names is (idx, term), one row per column of the vectors. Each task adds up one vector per cluster, so a row's
    terms are never exploded or joined by key; rows without a cluster count for none.
    """
    centres = centroids(df.where(F.col(cluster).isNotNull()), cluster, vector)
    entries = centres.select(cluster, F.posexplode("centroid").alias("idx", "weight")).where("weight <> 0")
    return entries.join(F.broadcast(names), "idx").select(cluster, "term", "weight")


def cluster_keywords(centre_weights: DataFrame, cluster: str = "cluster_id", top: int = TOP_KEYWORDS) -> DataFrame:
    """(cluster, term, weight, rank): the heaviest terms of each centre; equal weights go by term."""
    order = Window.partitionBy(cluster).orderBy(F.desc(F.round("weight", 9)), "term")
    return centre_weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _listed(df: DataFrame, cluster: str, rank: str, value: str, output: str) -> DataFrame:
    """Values of a cluster in rank order. Every cluster has a fixed small number of them."""
    ordered = F.array_sort(F.collect_list(F.struct(rank, value)))
    return df.groupBy(cluster).agg(F.transform(ordered, lambda s: s[value]).alias(output))


def cluster_report(
    df: DataFrame,
    centre_weights: DataFrame,
    key: str = "msg_id",
    cluster: str = "cluster_id",
    text: str = "text",
    top: int = TOP_KEYWORDS,
    seed: int = SEED,
) -> DataFrame:
    """(cluster_id, suggested_name, n_samples, top_keywords, examples) per non-empty cluster."""
    chosen = cluster_examples(df, cluster, key, seed=seed)
    # A few rows per cluster are broadcast to fetch their texts.
    examples = df.select(key, text).join(F.broadcast(chosen), key)
    sizes = cluster_sizes(df, cluster).withColumnRenamed("n", "n_samples")
    keywords = _listed(cluster_keywords(centre_weights, cluster, top), cluster, "rank", "term", "top_keywords")
    listed = _listed(examples, cluster, "example_rank", text, "examples")
    return (
        sizes.join(keywords, cluster, "left").join(listed, cluster, "left")
        .select(
            cluster,
            F.format_string(CLUSTER_NAME, F.get("top_keywords", F.lit(0))).alias("suggested_name"),
            "n_samples", "top_keywords", "examples",
        )
    )
