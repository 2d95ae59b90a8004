"""Clustering, neighbours and anomaly scores.

MLlib does the fitting (``KMeans`` with k-means||, ``BisectingKMeans``),
scores come from ``ClusteringEvaluator`` or one aggregate (Calinski-Harabasz).
Nearest neighbours are in ``neighbours``, density clustering in ``density``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neighbours import Lists, exact_neighbours, list_neighbours, vote


def as_vectors(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def calinski_harabasz(df: DataFrame, features_arr: str, label: str) -> float:
    """CH = [B/(k-1)] / [W/(n-k)] from per-cluster sums (one grouped
    aggregate of sums and squared norms; no pairwise distances)."""
    dim = len(df.select(features_arr).first()[0])
    x = F.col(features_arr)
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                *[F.sum(x[i]).alias(f"s{i}") for i in range(dim)],
                                F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)).alias("q")).collect()
    n = sum(r["n"] for r in per)
    k = len(per)
    tot = np.sum([[r[f"s{i}"] for i in range(dim)] for r in per], axis=0)
    gm = tot / n
    w = 0.0
    b = 0.0
    for r in per:
        s = np.array([r[f"s{i}"] for i in range(dim)])
        c = s / r["n"]
        w += r["q"] - r["n"] * float(c @ c)
        b += r["n"] * float((c - gm) @ (c - gm))
    if k < 2 or w == 0:
        return float("nan")
    return (b / (k - 1)) / (w / (n - k))


def kmeans_grid(df: DataFrame, features: str, ks: Sequence[int], seed: int = 13,
                metric: str = "squaredEuclidean") -> DataFrame:
    """For each k: inertia (training cost), silhouette (named metric) and
    Calinski-Harabasz; ``best`` marks the k with the highest silhouette."""
    spark = df.sparkSession
    rows = []
    arr = df.withColumn("_arr", vector_to_array(F.col(features)))
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol=features, initMode="k-means||").fit(df)
        pred = model.transform(arr)
        sil = ClusteringEvaluator(featuresCol=features, distanceMeasure=metric).evaluate(pred)
        ch = calinski_harabasz(pred, "_arr", "prediction")
        rows.append((int(k), float(model.summary.trainingCost), float(sil), float(ch)))
    out = spark.createDataFrame(rows, "k int, inertia double, silhouette double, calinski_harabasz double")
    best = max(rows, key=lambda r: r[2])[0]
    return out.withColumn("silhouette_metric", F.lit(metric)).withColumn("best", F.col("k") == F.lit(best))


def kmeans_labels(df: DataFrame, key: str, cols: Sequence[str], k: int, seed: int = 13) -> DataFrame:
    """K-means on the complete rows; labels renumbered by the lexicographic
    order of the centres; rows with nulls keep a null label (left join by key)."""
    from pyspark.ml.feature import VectorAssembler
    complete = df.select(key, *cols).na.drop(subset=list(cols))
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(complete)
    model = KMeans(k=k, seed=seed).fit(vec)
    centres = [tuple(c.tolist()) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    remap = F.create_map(*[x for new, old in enumerate(order) for x in (F.lit(old), F.lit(new))])
    lab = model.transform(vec).select(key, remap[F.col("prediction")].alias("cluster"))
    return df.join(lab, key, "left")


def bisecting(df: DataFrame, features: str, ks: Sequence[int], seed: int = 13) -> DataFrame:
    """Divisive hierarchical clustering (``BisectingKMeans``) scored by k."""
    spark = df.sparkSession
    rows = []
    for k in ks:
        m = BisectingKMeans(k=k, seed=seed, featuresCol=features).fit(df)
        sil = ClusteringEvaluator(featuresCol=features).evaluate(m.transform(df))
        rows.append((int(k), float(m.summary.trainingCost), float(sil)))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def prototype_anomalies(df: DataFrame, key: str, col: str, k: int = 132, neighbours: int = 4,
                        threshold: float = 0.8, seed: int = 13) -> DataFrame:
    """Map rows to ``k`` K-means prototypes; a prototype's score is its mean
    distance to its ``neighbours`` nearest prototypes, scaled to [0, 1]; rows of
    prototypes scoring >= ``threshold`` are returned with their score.
    The prototype table (k rows) is the only data reaching the driver."""
    vec = as_vectors(df, col)
    model = KMeans(k=k, seed=seed).fit(vec)
    c = np.array([v.tolist() for v in model.clusterCenters()])
    dist = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    nn = np.sort(dist, axis=1)[:, :neighbours].mean(axis=1)
    score = (nn - nn.min()) / (nn.max() - nn.min()) if nn.max() > nn.min() else np.zeros_like(nn)
    spark = df.sparkSession
    proto = spark.createDataFrame([(int(i), float(s)) for i, s in enumerate(score)], "prototype int, score double")
    mapped = model.transform(vec).select(key, F.col("prediction").alias("prototype"))
    flagged = F.broadcast(proto.where(F.col("score") >= threshold))  # at most k rows
    return mapped.join(flagged, "prototype")


def knn(base: DataFrame, queries: DataFrame, key: str, col: str, label: str, k: int = 5,
        weights: str = "uniform", task: str = "classify", index: Lists | None = None) -> DataFrame:
    """K nearest neighbours (Euclidean) of every query row among the base
    rows, then a class vote (or mean) with uniform or 1/distance weights.

    Exact in blocks, whatever the sizes; with an ``index`` of ``fit_lists`` only
    the lists nearest to a query are searched."""
    found = (exact_neighbours(base, queries, key, col, k, (label,)) if index is None
             else list_neighbours(base, queries, key, col, index, k, (label,)))
    return vote(found, label, weights, task)


def gap_curve(df: DataFrame, features_arr: str, ks: Sequence[int], seed: int = 13,
              reference: str = "unit") -> DataFrame:
    """gap(k) = log(inertia of uniform reference rows) - log(inertia of
    data); the reference has the same row count, drawn in the unit cube (as
    the reference implementation) or in the data's bounding box."""
    dim = len(df.select(features_arr).first()[0])
    data = as_vectors(df, features_arr)
    if reference == "unit":
        lo, hi = [0.0] * dim, [1.0] * dim
    else:
        st = df.agg(*[F.min(F.col(features_arr)[i]).alias(f"a{i}") for i in range(dim)],
                    *[F.max(F.col(features_arr)[i]).alias(f"b{i}") for i in range(dim)]).first()
        lo, hi = [st[f"a{i}"] for i in range(dim)], [st[f"b{i}"] for i in range(dim)]
    ref = df.select(F.array(*[(F.lit(lo[i]) + F.rand(seed + i) * F.lit(hi[i] - lo[i])) for i in range(dim)]).alias("_r"))
    ref = as_vectors(ref, "_r")
    rows = []
    for k in ks:
        wd = KMeans(k=k, seed=seed).fit(data).summary.trainingCost
        wr = KMeans(k=k, seed=seed).fit(ref).summary.trainingCost
        rows.append((int(k), float(math.log(wr) - math.log(wd)), float(wd), float(wr)))
    return df.sparkSession.createDataFrame(rows, "k int, gap double, inertia_data double, inertia_reference double")
