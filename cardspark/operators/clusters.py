"""Clusters of cards and what explains them."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CARD = "CardHolderID"
# fixed values: forest size, and the depth Spark allows
TREES = 50
MAX_DEPTH = 30


@dataclass(frozen=True)
class Clusters:
    """A fitted model with its small tables (one row per cluster)."""

    model: KMeansModel
    columns: list[str]
    sizes: DataFrame    # ClusterID, cluster_size
    centers: DataFrame  # ClusterID, one column per feature
    labels: DataFrame   # ClusterID, ClusterLabels


def features(columns: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def fit_clusters(
    df: DataFrame, columns: list[str], k: int, seed: int = 0, key: str = CARD, max_iter: int = 50
) -> tuple[Clusters, DataFrame]:
    """Fit k clusters on numeric columns; returns the model and (key, ClusterID, ClusterLabels)."""
    data = _assembled(df, columns)
    # every iteration reads the vectors again, so they are kept on the executors while fitting
    data = data.select(key, "features").persist()
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="ClusterID").fit(data)
    data.unpersist()
    members = model.transform(_assembled(df, columns)).select(
        key, "ClusterID", F.lit("").alias("ClusterLabels")
    )
    return cluster_tables(df.sparkSession, model, columns, members), members


def cluster_tables(spark: SparkSession, model: KMeansModel, columns: list[str], members: DataFrame) -> Clusters:
    """Sizes, centres and labels of the clusters; the centres are k rows."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = "ClusterID int, " + ", ".join(f"`{c}` double" for c in columns)
    centers = spark.createDataFrame(rows, schema)
    sizes = members.groupBy("ClusterID").agg(F.count("*").alias("cluster_size"))
    labels = centers.select("ClusterID", F.lit("").alias("ClusterLabels"))
    return Clusters(model, columns, sizes, centers, labels)


def relabel(clusters: Clusters, mapping: dict[int | str, str], by: str = "ClusterID") -> Clusters:
    """Set the label of clusters chosen by id or by their present label."""
    current = F.col(by).cast("string")
    label = F.col("ClusterLabels")
    for old, new in mapping.items():
        label = F.when(current == str(old), F.lit(new)).otherwise(label)
    labels = clusters.labels.withColumn("ClusterLabels", label)
    names = labels.select("ClusterID", "ClusterLabels")
    return replace(
        clusters, labels=labels,
        sizes=clusters.sizes.drop("ClusterLabels").join(names, "ClusterID", "left"),
        centers=clusters.centers.drop("ClusterLabels").join(names, "ClusterID", "left"),
    )


def distances(vector: Column, centers: list[list[float]]) -> Column:
    """Array of Euclidean distances to fixed centres, without a Python function."""
    def one(center: list[float]) -> Column:
        point = F.array(*[F.lit(float(x)) for x in center])
        squares = F.zip_with(vector, point, lambda x, c: (x - c) * (x - c))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))
    return F.array(*[one(c) for c in centers])


def score_with_centers(
    df: DataFrame, vector: Column, centers: list[list[float]], labels: DataFrame | None = None, key: str = CARD
) -> DataFrame:
    """Nearest centre, its distance, the mean distance to the others, and their difference."""
    d = F.col("__d")
    total = F.aggregate(d, F.lit(0.0), lambda s, x: s + x)
    near = F.array_min(d)
    scored = df.select(key, distances(vector, centers).alias("__d")).select(
        key,
        (F.array_position(d, near) - 1).cast("int").alias("ClusterID"),
        near.alias("min_distance"),
        F.try_divide(total - near, F.lit(float(len(centers) - 1))).alias("avg_distance_other_clusters"),
    )
    gap = F.abs(F.col("avg_distance_other_clusters") - F.col("min_distance"))
    scored = scored.withColumn("std_distance_other_clusters", gap)
    if labels is None:
        return scored.withColumn("ClusterLabels", F.lit(""))
    # one label row per centre, so this side has len(centers) rows; a centre without one has the label ''
    return scored.join(F.broadcast(labels.select("ClusterID", "ClusterLabels")), "ClusterID", "left").select(
        key, "ClusterID", "min_distance", "avg_distance_other_clusters", "std_distance_other_clusters",
        F.coalesce("ClusterLabels", F.lit("")).alias("ClusterLabels"),
    )


def score_clusters(clusters: Clusters, df: DataFrame, key: str = CARD) -> DataFrame:
    centers = [list(map(float, c)) for c in clusters.model.clusterCenters()]
    return score_with_centers(df, features(clusters.columns), centers, clusters.labels, key)


def fit_properties(df: DataFrame, clusters: Clusters, members: DataFrame, key: str = CARD, tolerance: float = 0.02) -> DataFrame:
    """Per cluster what must hold of a fit, recomputed from all rows.

    ClusterID, n_members, size_agrees (with the table of sizes), all_nearest (no
    member is nearer to another centre), centre_is_mean (every coordinate within
    `tolerance` of the mean of the members; the last step of a fit moves the
    centres a little), one_label.
    """
    centers = [list(map(float, c)) for c in clusters.model.clusterCenters()]
    scored = score_clusters(clusters, df, key).select(key, F.col("ClusterID").alias("nearest"), "ClusterLabels")
    vectors = df.select(key, features(clusters.columns).alias("__x"))
    rows = members.select(key, "ClusterID").join(scored, key).join(vectors, key)
    means = [F.avg(F.col("__x")[j]).alias(f"__m{j}") for j in range(len(clusters.columns))]
    own = F.element_at(F.array(*[F.array(*[F.lit(x) for x in c]) for c in centers]), F.col("ClusterID") + 1)
    off = F.array_max(F.zip_with(F.array(*[F.col(f"__m{j}") for j in range(len(means))]), own, lambda a, b: F.abs(a - b)))
    per = rows.groupBy("ClusterID").agg(
        F.count("*").alias("n_members"), F.min(F.col("nearest") == F.col("ClusterID")).alias("all_nearest"),
        (F.countDistinct("ClusterLabels") == 1).alias("one_label"), *means)
    return per.join(clusters.sizes.select("ClusterID", "cluster_size"), "ClusterID", "full").select(
        "ClusterID", "n_members", F.col("n_members").eqNullSafe(F.col("cluster_size")).alias("size_agrees"), "all_nearest",
        (off <= tolerance).alias("centre_is_mean"), "one_label")


def explain_clusters(
    df: DataFrame, columns: list[str], label: str = "ClusterID", num_clusters: int | None = None, seed: int = 0
) -> RandomForestClassificationModel:
    """Random forest that predicts the cluster; depth = number of clusters, of which Spark allows `MAX_DEPTH`."""
    data = df.select(features(columns).alias("__x"), F.col(label).cast("double").alias("label")).select(
        array_to_vector("__x").alias("features"), "label"
    )
    if num_clusters is None:
        num_clusters = data.select("label").distinct().count()
    if num_clusters > MAX_DEPTH:
        raise ValueError(f"a forest of depth {num_clusters} is beyond Spark's {MAX_DEPTH}; pass a smaller num_clusters")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=max(1, num_clusters), seed=seed)
    return forest.fit(data)


def feature_importance(
    spark: SparkSession, model: RandomForestClassificationModel, columns: list[str], top: int | None = None
) -> DataFrame:
    """(feature, FeatureImportance), largest first; one row per column of the model."""
    rows = list(zip(columns, (float(x) for x in model.featureImportances.toArray())))
    out = spark.createDataFrame(rows, "feature string, FeatureImportance double")
    out = out.orderBy(F.desc("FeatureImportance"), "feature")
    return out if top is None else out.limit(top)


def distance_distribution(scored: DataFrame) -> DataFrame:
    """Quartiles, range and mean of the nearest-centre distance per cluster."""
    d = F.col("min_distance")
    q = F.percentile(d, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return scored.groupBy("ClusterID").agg(
        F.count("*").alias("n"), F.min(d).alias("d_min"), q.alias("q"), F.max(d).alias("d_max"),
        F.avg(d).alias("d_avg"),
    ).select("ClusterID", "n", "d_min", F.col("q")[0].alias("d_q1"), F.col("q")[1].alias("d_median"),
             F.col("q")[2].alias("d_q3"), "d_max", "d_avg")
