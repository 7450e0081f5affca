"""Clustering, reduction and classification through Spark ML, and agglomeration of a few centroids."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """Rows with an array of numbers as an ML vector; rows without one are left out."""
    return df.where(F.col(array).isNotNull() & (F.size(array) > 0)).withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def kmeans(df: DataFrame, k: int, seed: int = 7, features: str = "features", out: str = "cluster", max_iter: int = 10) -> DataFrame:
    """Cosine k-means: every row with its cluster and the cosine to the cluster's centre (an action to fit)."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=out, distanceMeasure="cosine", maxIter=max_iter).fit(df)
    centres = np.array(model.clusterCenters())
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    dim = df.sparkSession.createDataFrame(rows, f"{out} int, centre array<double>")  # k rows
    a, b = vector_to_array(features), F.col("centre")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return model.transform(df).join(F.broadcast(dim), out).withColumn("confidence", F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))).drop("centre")


def reduce_pca(df: DataFrame, k: int, features: str = "features", out: str = "reduced") -> DataFrame:
    """The first k principal components as an array (an action to fit)."""
    return PCA(k=k, inputCol=features, outputCol="_pca").fit(df).transform(df).withColumn(out, vector_to_array("_pca")).drop("_pca")


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Cosine silhouette (an action); 0 where there is a single cluster."""
    if df.select(cluster).distinct().limit(2).count() < 2:
        return 0.0
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, distanceMeasure="cosine").evaluate(df)


def agglomerate(centroids: list[tuple[int, list[float], float]], most_distance: float) -> dict[int, int]:
    """Themes of a few centroids (id, vector, weight): average linkage on cosine distance up to ``most_distance``,
    numbered by falling weight, ties by the least id. Input is bounded by the number of clusters."""
    ids = [c[0] for c in centroids]
    if not ids:
        return {}
    x = np.array([c[1] for c in centroids], dtype=float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    d = 1 - x @ x.T
    groups: dict[int, list[int]] = {i: [i] for i in range(len(ids))}
    np.fill_diagonal(d, np.inf)
    # Joining two groups makes their distance to any other the mean weighted by size: one row of the matrix is renewed.
    while len(groups) > 1:
        i, j = sorted(int(v) for v in np.unravel_index(np.argmin(d), d.shape))
        if d[i, j] > most_distance:
            break
        m, n = len(groups[i]), len(groups[j])
        d[i] = d[:, i] = (m * d[i] + n * d[j]) / (m + n)
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
        groups[i] += groups.pop(j)
    weight = [c[2] for c in centroids]
    ordered = sorted(groups.values(), key=lambda g: (-sum(weight[i] for i in g), min(ids[i] for i in g)))
    return {ids[i]: n for n, g in enumerate(ordered) for i in g}


def preprocess(numeric: list[str], categorical: list[str], out: str = "features") -> Pipeline:
    """Median imputation, scaling without centring, one-hot codes with a place for unseen values."""
    stages = []
    if numeric:
        stages += [Imputer(strategy="median", inputCols=numeric, outputCols=[f"_i_{c}" for c in numeric]), VectorAssembler(inputCols=[f"_i_{c}" for c in numeric], outputCol="_num"), StandardScaler(inputCol="_num", outputCol="_scaled", withMean=False)]
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"_x_{c}", handleInvalid="keep"))
    if categorical:
        stages.append(OneHotEncoder(inputCols=[f"_x_{c}" for c in categorical], outputCols=[f"_h_{c}" for c in categorical], handleInvalid="keep"))
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=(["_scaled"] if numeric else []) + [f"_h_{c}" for c in categorical], outputCol=out)])


def balanced(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Adds row weights by which both labels weigh the same."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = n.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return df.join(F.broadcast(n.crossJoin(total).select(label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias(out))), label)  # one row per label


def classifier(kind: str, label: str, features: str = "features", weight: str = "weight", seed: int = 7):
    """``logistic`` (elastic net) or ``boosted`` trees."""
    if kind == "logistic":
        return LogisticRegression(labelCol=label, featuresCol=features, weightCol=weight, elasticNetParam=0.5, regParam=0.01, maxIter=50)
    return GBTClassifier(labelCol=label, featuresCol=features, weightCol=weight, seed=seed, maxIter=20, maxDepth=4)


def theme_layer(rows: DataFrame, cluster: str, vector: str, most_distance: float) -> DataFrame:
    """The rows with the theme of their cluster: centroids of the clusters, one each, are agglomerated and joined back.
    Rows without a cluster have no theme."""
    from tarnwerk.operators.retrieval import centroids

    n = rows.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"))
    c = centroids(rows.where(F.col(cluster).isNotNull()), cluster, vector).join(n, cluster).orderBy(cluster).collect()  # a row per cluster
    themes = agglomerate([(r[cluster], r["centroid"], r["_n"]) for r in c], most_distance)
    dim = rows.sparkSession.createDataFrame(sorted(themes.items()), f"{cluster} {rows.schema[cluster].dataType.simpleString()}, theme int")
    return rows.join(F.broadcast(dim), cluster, "left")
