"""Density clustering and nearest neighbours over the generated tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import density as D
from ..operators import neighbours as NN
from ..operators import split as S
from .order_plans import _h
from .registry import Tables, plan

EPS, MIN_SAMPLES = [0.08, 0.11], 6

# z-scores of the parts, pairs within each eps, core points, reachability between them
_DBSCAN = f"""
WITH RECURSIVE st AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp,
  stddev_pop(p_retailprice) AS sp FROM part),
z AS (SELECT p_partkey AS k, (p_size - ms) / ss AS x, (p_retailprice - mp) / sp AS y FROM part, st),
e AS (SELECT unnest({EPS}) AS eps),
d AS (SELECT eps, a.k AS a, b.k AS b FROM e, z a JOIN z b ON abs(a.x - b.x) <= {max(EPS)}
      WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= eps * eps),
core AS (SELECT eps, a AS k FROM d GROUP BY 1, 2 HAVING count(*) >= {MIN_SAMPLES}),
link AS (SELECT d.* FROM d JOIN core x ON x.eps = d.eps AND x.k = d.a JOIN core y ON y.eps = d.eps AND y.k = d.b),
r AS (SELECT eps, k, k AS m FROM core UNION SELECT l.eps, l.b, r.m FROM r JOIN link l ON l.eps = r.eps AND l.a = r.k
      WHERE r.m < l.b),
c AS (SELECT eps, k, min(m) AS cluster FROM r GROUP BY 1, 2),
lab AS (SELECT e.eps, z.k, x, y, min(c.cluster) AS cluster FROM e CROSS JOIN z LEFT JOIN d ON d.eps = e.eps AND d.a = z.k
        LEFT JOIN c ON c.eps = e.eps AND c.k = d.b
        GROUP BY 1, 2, 3, 4),
own AS (SELECT l.eps, l.k, l.x, l.y, coalesce(c.cluster, l.cluster) AS cluster FROM lab l LEFT JOIN c USING (eps, k))"""


@plan("l03_dbscan", "L03,M14", _DBSCAN + """,
one AS (SELECT * FROM own WHERE cluster IS NOT NULL),
mean AS (SELECT a.eps, a.k, a.cluster AS ca, b.cluster AS cb, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS s,
         count(*) AS n FROM one a JOIN one b ON a.eps = b.eps GROUP BY ALL),
ab AS (SELECT eps, k, max(s / (n - 1)) FILTER (ca = cb AND n > 1) AS a, min(s / n) FILTER (ca <> cb) AS b FROM mean GROUP BY 1, 2),
sil AS (SELECT eps, avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS s
        FROM ab GROUP BY 1 HAVING count(b) > 0),
sc AS (SELECT eps, count(DISTINCT cluster) AS n_clusters, count(*) FILTER (cluster IS NULL) AS n_noise FROM own GROUP BY 1),
j AS (SELECT sc.*, s FROM sc LEFT JOIN sil USING (eps))
SELECT eps, 6 AS min_samples, n_clusters, n_noise, round(s, 6) AS silhouette,
  coalesce(row_number() OVER (ORDER BY s DESC NULLS LAST, eps) = 1 AND s IS NOT NULL, false) AS best FROM j""")
def l03(spark, sf_dir):
    scores, _ = D.dbscan(Tables(spark, sf_dir).part, "p_partkey", ["p_size", "p_retailprice"], EPS, MIN_SAMPLES)
    return scores.withColumn("silhouette", F.round("silhouette", 6))


@plan("l03_dbscan_labels", "L03", _DBSCAN + """
SELECT k AS p_partkey, eps, CASE WHEN cluster IS NULL THEN -1 ELSE
  dense_rank() OVER (PARTITION BY eps ORDER BY cluster NULLS LAST) - 1 END AS cluster FROM own""")
def l03_labels(spark, sf_dir):
    _, labels = D.dbscan(Tables(spark, sf_dir).part, "p_partkey", ["p_size", "p_retailprice"], EPS, MIN_SAMPLES)
    return labels


@plan("l04_single_linkage_cut", "L04", """
WITH RECURSIVE st AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp,
  stddev_pop(p_retailprice) AS sp FROM part),
z AS (SELECT p_partkey AS k, (p_size - ms) / ss AS x, (p_retailprice - mp) / sp AS y FROM part, st),
e AS (SELECT unnest([0.05, 0.07]) AS distance),
d AS (SELECT distance, a.k AS a, b.k AS b FROM e, z a JOIN z b ON abs(a.x - b.x) <= 0.07
      WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= distance * distance),
r AS (SELECT distance, a AS k, a AS m FROM d WHERE a = b UNION
      SELECT d.distance, d.b, r.m FROM r JOIN d ON d.distance = r.distance AND d.a = r.k WHERE r.m < d.b)
SELECT k AS p_partkey, distance, min(m) AS cluster FROM r GROUP BY 1, 2""")
def l04_cut(spark, sf_dir):
    return D.single_linkage_cut(Tables(spark, sf_dir).part, "p_partkey", ["p_size", "p_retailprice"], [0.05, 0.07])


_NEAR = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
near AS (SELECT q.vec_id AS query, b.vec_id AS base, b.label AS nlabel, list_distance(q.v, b.v) AS dist,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, b.v), b.vec_id) AS rank
         FROM v q JOIN v b ON {on})"""


@plan("l07_neighbours", "L07", _NEAR.format(on="q.vec_id % 20 = 0") + """
SELECT query, base, round(dist, 6) AS dist, rank::INT AS rank FROM near WHERE rank <= 6""")
def l07_neighbours(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    found = NN.exact_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 6)
    return found.select("query", "base", F.round("dist", 6).alias("dist"), "rank")


@plan("l07_list_recall", "L07", """
SELECT count(*) AS n_queries, 5 * count(*) AS n_true, true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0""")
def l07_recall(spark, sf_dir):
    """Recall of the list search for ids divisible by 20, a query's own row left out."""
    e = Tables(spark, sf_dir).embeddings
    queries = e.where("vec_id % 20 = 0")
    index = NN.fit_lists(e, "vec_id", "embedding", k=5)
    others = lambda df: df.where("query <> base").withColumn(
        "place", F.rank().over(NN.Window.partitionBy("query").orderBy("rank"))).where("place <= 5")
    true = others(NN.exact_neighbours(e, queries, "vec_id", "embedding", 6))
    found = others(NN.list_neighbours(e, queries, "vec_id", "embedding", index, 6))
    return NN.recall_of(found, true).select("n_queries", "n_true", (F.col("recall") >= 0.9).alias("recall_reached"))


_KNN = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v, label, {h} / 4294967296.0 < 0.8 AS base FROM embeddings),
near AS (SELECT q.vec_id AS query, q.label, b.label AS nlabel, list_distance(q.v, b.v) AS dist,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, b.v), b.vec_id) AS rank
         FROM v q JOIN v b ON NOT q.base AND b.base),
votes AS (SELECT query, label, nlabel, sum(1 / greatest(dist, 1e-12)) AS w FROM near WHERE rank <= 5 GROUP BY ALL)
SELECT query, arg_min(nlabel, (-w, nlabel)) AS prediction, label FROM votes GROUP BY query, label"""


@plan("l07_knn", "L07,B01", _KNN.format(h=_h("vec_id")))
def l07(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    s = S.random_split(e, "vec_id", [0.8, 0.2], names=("base", "query"))
    pred = CL.knn(s.where(F.col("split") == "base"), s.where(F.col("split") == "query"), "vec_id", "embedding",
                  "label", k=5, weights="distance")
    return pred.join(e.select(F.col("vec_id").alias("query"), "label"), "query")
