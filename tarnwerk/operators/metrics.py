"""Metrics of scores against labels, as grouped aggregation over distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwerk.operators.windows import ranked, running


def curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, above_pos, above_neg): per distinct score the labels at it and above it.

    Reduced to one row per distinct score first; the running sums over those are made by range, never in one task. Rows
    without a score or label are left out.
    """
    g = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("score")).agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))
    return running(g, [F.desc("score")], {"above_pos": F.col("pos"), "above_neg": F.col("neg")})


def summary(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: ROC AUC with ties counted half, average precision, Brier score and the confusion counts at a threshold.
    AUC is null where only one label occurs."""
    c = curve(df, label, score)
    prec = F.try_divide((F.col("above_pos") + F.col("pos")).cast("double"), (F.col("above_pos") + F.col("pos") + F.col("above_neg") + F.col("neg")).cast("double"))
    at = F.col("score") >= threshold
    a = c.agg(
        F.sum(F.col("neg") * (F.col("above_pos") + F.col("pos") / 2.0)).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(F.col("pos") * prec).alias("ap"),
        F.sum(F.col("pos") * (1 - F.col("score")) ** 2 + F.col("neg") * F.col("score") ** 2).alias("brier"), F.sum(F.when(at, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(at, F.col("neg")).otherwise(0)).alias("fp"),
    )
    return a.select(
        F.round(F.try_divide("wins", (F.col("p") * F.col("n")).cast("double")), 6).alias("roc_auc"), F.round(F.try_divide("ap", F.col("p").cast("double")), 6).alias("average_precision"),
        F.round(F.try_divide("brier", (F.col("p") + F.col("n")).cast("double")), 6).alias("brier"), "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"),
    )


def capture_at(df: DataFrame, label: str, score: str, share: float, tie: str) -> DataFrame:
    """Recall, precision and lift among the best ceil(share x n) scores."""
    r = ranked(df.select(label, score, tie), score, [tie])
    n = df.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"))
    x = r.crossJoin(F.broadcast(n)).where(F.col("rank_no") <= F.ceil(F.col("n") * share)).agg(F.sum(label).alias("hit"), F.count(F.lit(1)).alias("k"), F.max("n").alias("n"), F.max("p").alias("p"))  # one row
    prec = F.col("hit") / F.col("k")
    return x.select("k", "hit", F.round(F.try_divide("hit", "p"), 6).alias("recall"), F.round(prec, 6).alias("precision"), F.round(F.try_divide(prec * F.col("n"), F.col("p")), 6).alias("lift"))


def correlations(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, correlation) of each feature with a target, from one pass."""
    one = df.agg(*[F.round(F.corr(F.col(c).cast("double"), F.col(target).cast("double")), 6).alias(c) for c in features])
    return one.unpivot([], features, "feature", "correlation")


def separation(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """One row: Davies-Bouldin and Calinski-Harabasz of clusters of vectors, by Euclidean distance to their centroids.
    Only the centroids, one per cluster, meet in pairs. Null vectors and clusters are left out; null with one cluster."""
    from tarnwerk.operators.retrieval import centroids

    x = df.where(F.col(vector).isNotNull() & F.col(cluster).isNotNull()).select(F.col(cluster).alias("c"), F.transform(vector, lambda v: v.cast("double")).alias("v"))
    far = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))
    c = centroids(x, "c", "v")
    inner = x.join(F.broadcast(c), "c").withColumn("d", far(F.col("v"), F.col("centroid"))).groupBy("c").agg(F.avg("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("w"), F.count(F.lit(1)).alias("n")).join(c, "c")
    a, b = inner.select(F.col("c").alias("i"), F.col("s").alias("si"), F.col("centroid").alias("ci")), inner.select(F.col("c").alias("j"), F.col("s").alias("sj"), F.col("centroid").alias("cj"))
    worst = a.join(F.broadcast(b), F.col("i") != F.col("j")).groupBy("i").agg(F.max((F.col("si") + F.col("sj")) / far(F.col("ci"), F.col("cj"))).alias("r"))
    whole = centroids(x.withColumn("_one", F.lit(0)), "_one", "v").select(F.col("centroid").alias("g"))
    between = inner.crossJoin(F.broadcast(whole)).agg(F.sum(F.col("n") * F.pow(far(F.col("centroid"), F.col("g")), 2)).alias("b"), F.sum("w").alias("w"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))  # one row
    ch = F.try_divide(F.col("b") / (F.col("k") - 1), F.col("w") / (F.col("n") - F.col("k")))
    return worst.agg(F.avg("r").alias("_db")).crossJoin(between).select(F.round("_db", 4).alias("davies_bouldin"), F.round(ch, 4).alias("calinski_harabasz"))
