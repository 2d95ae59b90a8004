"""Density clustering on a grid: DBSCAN (L03), single-linkage cut (L04), Euclidean silhouette.

Equal points are first put together with their weight. Cells have the side
eps/sqrt(d), so two points of one cell are within eps: a cell that weighs
``min_samples`` holds core points only, without any distance. What remains open
(how many neighbours a point of a light cell has, whether two cells touch, which
cluster a border point joins) is settled between boxes: cells are cut into nodes
of a quarter of the side, a pair of nodes whose farthest corners are within eps
counts as a whole, one whose nearest corners are not is dropped, and only
undecided pairs are cut again. Rows are compared when the pairs left are few for
the table's size. No pairs arise inside a cell, and a cell that holds a third
of all rows is a handful of nodes.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .order import land, row_positions

#: A node is cut into so many parts along each dimension.
CUT = 4
#: Pairs of rows compared for each row of the table, before nodes are cut again.
PAIRS_PER_ROW = 50
#: Rounding allowance of a box's distance bounds.
SLACK = 1e-9
#: Dimensions beyond which a grid has too many neighbours.
MOST_DIMENSIONS = 4
#: Cuts of a cell at most: nodes then are far below any eps, and rows are compared.
MOST_CUTS = 12


def scaled_points(df: DataFrame, key: str, cols: Sequence[str], scale: bool = True) -> DataFrame:
    """(k, c): key and coordinates of the rows that have all of them, each column
    as z-score (population deviation; a constant column becomes 0) if ``scale``."""
    num = [F.col(f"`{c}`").cast("double") for c in cols]
    rows = df.select(F.col(f"`{key}`").alias("k"), *[c.alias(f"x{i}") for i, c in enumerate(num)]).na.drop()
    rows = rows.where(~F.exists(F.array(*[F.col(f"x{i}") for i in range(len(num))]), lambda v: F.isnan(v) | (F.abs(v) == float("inf"))))
    if not scale:
        return rows.select("k", F.array(*[f"x{i}" for i in range(len(num))]).alias("c"))
    st = rows.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(len(num)) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return rows.select("k", F.array(*[(F.col(f"x{i}") - F.lit(st[f"m{i}"])) / F.lit(st[f"s{i}"] or 1.0)
                                      for i in range(len(num))]).alias("c"))


class Grid:
    """Boxes of one eps over ``dim`` dimensions."""

    def __init__(self, eps: float, dim: int):
        if not 1 <= dim <= MOST_DIMENSIONS:
            raise ValueError(f"a grid over {dim} dimensions; at most {MOST_DIMENSIONS}")
        self.eps, self.dim = float(eps), dim
        self.side = self.eps / math.sqrt(dim) * (1 - SLACK)
        reach = range(-math.isqrt(dim) - 1, math.isqrt(dim) + 2)
        near = lambda o: sum(max(0, abs(x) - 1) ** 2 for x in o) * self.side ** 2 <= self.eps ** 2 * (1 + SLACK)
        self.offsets = [o for o in itertools.product(reach, repeat=dim) if any(o) and near(o)]

    def size(self, level: int) -> float:
        return self.side / CUT ** level

    def node(self, c: Column, level: int) -> Column:
        return F.transform(c, lambda v: F.floor(v / F.lit(self.size(level))).cast("long"))

    def neighbours(self, cell: Column, half: bool = False) -> Column:
        """Cells that hold a point within eps of one of ``cell``; ``half``: each pair once."""
        some = [o for o in self.offsets if o > (0,) * self.dim] if half else self.offsets
        offsets = F.from_json(F.lit(json.dumps(some)), "array<array<bigint>>")  # a constant
        return F.transform(offsets, lambda o: F.zip_with(cell, o, lambda x, y: x + y))

    def _square(self, near: list[Column]) -> Column:
        return sum((v * v for v in near[1:]), near[0] * near[0])

    def box_bounds(self, a: Column, b: Column, level: int) -> tuple[Column, Column]:
        """(all pairs of two nodes are within eps, no pair is)."""
        s, gap = F.lit(self.size(level)), [F.abs(a[i] - b[i]) for i in range(self.dim)]
        far = self._square([(g + 1) * s for g in gap])
        near = self._square([F.greatest(g - 1, F.lit(0)) * s for g in gap])
        return far <= self.eps ** 2 * (1 - SLACK), near > self.eps ** 2 * (1 + SLACK)

    def point_bounds(self, c: Column, node: Column, level: int) -> tuple[Column, Column]:
        s = F.lit(self.size(level))
        low = [node[i] * s - c[i] for i in range(self.dim)]
        far = self._square([F.greatest(F.abs(x), F.abs(x + s)) for x in low])
        near = self._square([F.greatest(x, -(x + s), F.lit(0.0)) for x in low])
        return far <= self.eps ** 2 * (1 - SLACK), near > self.eps ** 2 * (1 + SLACK)

    def within(self, a: Column, b: Column) -> Column:
        return self._square([a[i] - b[i] for i in range(self.dim)]) <= F.lit(self.eps ** 2)


def nodes(points: DataFrame, grid: Grid, level: int) -> DataFrame:
    """(parent, node, w, n): weight and number of points of each node, with the node above."""
    node = grid.node(F.col("c"), level)
    above = grid.node(F.col("c"), max(0, level - 1))
    return points.groupBy(node.alias("node"), above.alias("parent")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))


def reaching(queries: DataFrame, points: DataFrame, grid: Grid, need: int, n_points: int) -> DataFrame:
    """Groups of ``queries`` (g, c, cell, have) for which ``have`` plus the weight
    of the points of their cells within eps of c comes to ``need``: (g)."""
    level, open_, sure = 0, queries.select("g", "c", F.col("cell").alias("node"), "have"), None
    while True:
        boxes = nodes(points, grid, level)
        if level:
            pairs = open_.withColumnRenamed("node", "parent").join(boxes, "parent").drop("parent")
        else:
            pairs = open_.join(boxes.drop("parent"), "node")
        all_, none = grid.point_bounds(F.col("c"), F.col("node"), level)
        pairs = pairs.select("g", "c", "node", "have", "w", "n", all_.alias("all"), none.alias("none")).where("NOT none")
        # a group's bounds: what it has for sure, and what it may still get
        sums = pairs.groupBy("g").agg(F.max("have").alias("had"), F.sum(F.expr("if(all, w, 0)")).alias("more"),
                                      F.sum(F.expr("if(all, 0, w)")).alias("maybe"))
        state = land(sums.select("g", (F.col("had") + F.col("more")).alias("low"),
                                 (F.col("had") + F.col("more") + F.col("maybe")).alias("high")), "bounds")
        done = state.where(F.col("low") >= need).select("g")
        sure = done if sure is None else sure.unionByName(done)
        undecided = state.where((F.col("low") < need) & (F.col("high") >= need)).select("g", F.col("low").alias("have"))
        open_ = land(pairs.where("NOT all").drop("have").join(undecided, "g").select("g", "c", "node", "have", "n"), "open")
        work = open_.agg(F.sum("n").alias("work")).first()["work"] or 0
        open_ = open_.drop("n")
        if not work:
            return sure
        if work <= PAIRS_PER_ROW * n_points or level == MOST_CUTS:
            rows = points.select(grid.node(F.col("c"), level).alias("node"), F.col("c").alias("d"), "w")
            found = (open_.join(rows, "node").where(grid.within(F.col("c"), F.col("d")))
                     .groupBy("g").agg(F.max("have").alias("had"), F.sum("w").alias("more")))
            return sure.unionByName(found.where(F.col("had") + F.col("more") >= need).select("g"))
        level += 1


def touching(cells: DataFrame, core: DataFrame, grid: Grid, n_points: int) -> DataFrame:
    """(a, b): pairs of cells that hold core points within eps of each other."""
    pairs = cells.select(F.col("cell").alias("a"), F.explode(grid.neighbours(F.col("cell"), half=True)).alias("b"))
    pairs = pairs.join(cells.select(F.col("cell").alias("b")), "b").select("a", "b")
    level, open_, sure = 0, pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")), None
    while True:
        level += 1
        boxes = nodes(core, grid, level).select("parent", "node", "n")
        cut = (open_.join(boxes.select(F.col("parent").alias("x"), F.col("node").alias("x2"), F.col("n").alias("nx")), "x")
               .join(boxes.select(F.col("parent").alias("y"), F.col("node").alias("y2"), F.col("n").alias("ny")), "y"))
        all_, none = grid.box_bounds(F.col("x2"), F.col("y2"), level)
        cut = land(cut.select("a", "b", F.col("x2").alias("x"), F.col("y2").alias("y"), (F.col("nx") * F.col("ny")).alias("n"),
                              all_.alias("all"), none.alias("none")).where("NOT none").drop("none"), "boxes")
        done = cut.where("all").select("a", "b").distinct()
        sure = done if sure is None else sure.unionByName(done)
        open_ = cut.where("NOT all").join(done, ["a", "b"], "left_anti")
        work = open_.agg(F.sum("n").alias("work")).first()["work"] or 0
        if not work:
            return sure
        open_ = open_.select("a", "b", "x", "y")
        if work <= PAIRS_PER_ROW * n_points or level == MOST_CUTS:
            node = grid.node(F.col("c"), level)
            found = (open_.join(core.select(node.alias("x"), F.col("c").alias("c")), "x")
                     .join(core.select(node.alias("y"), F.col("c").alias("d")), "y")
                     .where(grid.within(F.col("c"), F.col("d"))).select("a", "b").distinct())
            return sure.unionByName(found)


def dbscan_points(points: DataFrame, eps: float, min_samples: int, dim: int) -> DataFrame:
    """(k, c, cluster) of ``points`` (k, c): cluster is the least key of its core
    points, null for noise. A border point joins the least cluster in reach."""
    grid = Grid(eps, dim)
    rows = points.withColumn("cell", grid.node(F.col("c"), 0))
    # equal points together: k is their least key
    flat = land(rows.groupBy("c", "cell").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("w")), "points")
    n_points = flat.count()
    cells = flat.groupBy("cell").agg(F.sum("w").alias("cell_w"))
    flat = land(flat.join(cells, "cell"), "weighed")
    light = flat.where(F.col("cell_w") < min_samples)
    asked = light.select(F.col("k").alias("g"), "c", F.explode(grid.neighbours(F.col("cell"))).alias("cell"), F.col("cell_w").alias("have"))
    reached = reaching(asked, flat, grid, min_samples, n_points).select(F.col("g").alias("k")).distinct()
    core = land(flat.where(F.col("cell_w") >= min_samples).unionByName(light.join(reached, "k", "left_semi").select(*flat.columns)), "core")
    core_cells = land(core.groupBy("cell").agg(F.min("k").alias("least")), "core_cells")
    linked = touching(core_cells.select("cell"), core, grid, n_points)
    label = components(core_cells.select(F.col("cell").alias("node")), linked)
    named = label.withColumnRenamed("node", "cell").join(core_cells, "cell")
    least = named.groupBy("label").agg(F.min("least").alias("cluster"))
    cluster = land(named.join(least, "label").select("cell", "cluster"), "clusters")
    # border: a light point beside core points of its own cell, or within eps of those of another one
    rest = land(light.join(core.select("k"), "k", "left_anti"), "rest")
    inside = rest.join(cluster, "cell").select("k", "cluster")
    asked = rest.select("k", "c", F.explode(grid.neighbours(F.col("cell"))).alias("cell")).join(cluster, "cell")
    # one question for each point and cell of core points
    asked = asked.select(F.struct("k", "cell").alias("g"), "c", "cell", F.lit(0).cast("long").alias("have"))
    touched = reaching(asked, core, grid, 1, n_points).distinct().select("g.k", "g.cell").join(cluster, "cell").select("k", "cluster")
    border = inside.unionByName(touched).groupBy("k").agg(F.min("cluster").alias("cluster"))
    of_point = core.join(cluster, "cell").select("c", "cluster").unionByName(rest.join(border, "k").select("c", "cluster"))
    return points.join(of_point, "c", "left").select("k", "c", "cluster")


def euclidean_silhouette(labelled: DataFrame, sample: int = 5000) -> float | None:
    """Mean Euclidean silhouette of at most ``sample`` rows of ``labelled``
    (k, c, cluster), drawn by the key's hash; None with fewer than two clusters.
    The sample is the reference's own; it is what is broadcast, and every task
    measures its share of it against the whole of it."""
    rows = labelled.where("cluster is not null").orderBy(F.md5(F.col("k").cast("string")), "k").limit(sample)
    # at most ``sample`` rows
    local = rows.collect()
    clusters = sorted({r["cluster"] for r in local})
    if len(clusters) < 2:
        return None
    code = {c: i for i, c in enumerate(clusters)}
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast((np.array([r["c"] for r in local], float), np.array([code[r["cluster"]] for r in local])))
    numbered = spark.range(len(local))

    def score(batches):
        x, lab = shared.value
        size = np.bincount(lab).astype(float)
        for pdf in batches:
            out = []
            for at in pdf["id"].to_numpy():
                d = np.bincount(lab, np.sqrt(((x - x[at]) ** 2).sum(axis=1)), len(size))
                own = lab[at]
                if size[own] == 1:
                    out.append(0.0)
                    continue
                a = d[own] / (size[own] - 1)
                b = np.min(np.delete(d / size, own))
                out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
            yield pd.DataFrame({"s": np.array(out, float)})

    return numbered.mapInPandas(score, "s double").agg(F.avg("s")).first()[0]


def squared_silhouette(labelled: DataFrame) -> float | None:
    """Silhouette by squared distances over all labelled rows; None with fewer than two clusters."""
    found = labelled.where("cluster is not null")
    names = found.select("cluster").distinct()
    if len(names.take(2)) < 2:
        return None
    vec = found.select(array_to_vector("c").alias("features"), "cluster")
    # cluster names become 0.0, 1.0, ... by rank of their hash; the evaluator needs doubles
    number = names.withColumn("prediction", F.monotonically_increasing_id().cast("double"))
    return float(ClusteringEvaluator(featuresCol="features").evaluate(vec.join(land(number, "names"), "cluster")))


def dbscan(df: DataFrame, key: str, cols: Sequence[str], eps_list: Sequence[float], min_samples: int = 100,
           scale: bool = True, silhouette: str = "euclidean") -> tuple[DataFrame, DataFrame]:
    """(scores, labels) over a list of eps.

    ``scores``: eps, min_samples, n_clusters, n_noise, silhouette (without noise,
    null below two clusters; ``euclidean`` on at most 5,000 rows as in M14 or
    ``squared`` over all), best (highest silhouette, the first of equals).
    ``labels``: key, eps, cluster (-1 noise, else from 0 by least core key). Rows
    with a null or non-finite coordinate are left out; without rows there are 0
    clusters. Results equal scikit-learn's for rows in key order."""
    points = land(scaled_points(df, key, cols, scale), "scaled")
    rows, labels = [], None
    for eps in eps_list:
        found = land(dbscan_points(points, eps, min_samples, len(cols)), "labelled")
        counts = found.agg(F.count_distinct("cluster").alias("n"), F.count_if(F.col("cluster").isNull()).alias("noise")).first()
        sil = euclidean_silhouette(found) if silhouette == "euclidean" else squared_silhouette(found)
        rows.append((float(eps), int(min_samples), counts["n"], counts["noise"], sil))
        order = cluster_numbers(found.where("cluster is not null").select("cluster").distinct())
        one = found.join(order, "cluster", "left").select(
            F.col("k").alias(key), F.lit(float(eps)).alias("eps"), F.coalesce("number", F.lit(-1).cast("long")).alias("cluster"))
        labels = one if labels is None else labels.unionByName(one)
    scored = [r for r in rows if r[4] is not None]
    best = max(scored, key=lambda r: r[4])[0] if scored else None
    scores = df.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows],
                                             "eps double, min_samples int, n_clusters long, n_noise long, silhouette double, best boolean")
    return scores, labels


def cluster_numbers(names: DataFrame) -> DataFrame:
    """(cluster, number): rank of each cluster's name, without a one-task window."""
    return row_positions(names, ["cluster"], out="pos").select("cluster", (F.col("pos") - 1).alias("number"))


def single_linkage_cut(df: DataFrame, key: str, cols: Sequence[str], distances: Sequence[float], scale: bool = True) -> DataFrame:
    """Clusters that single linkage leaves at each distance: key, distance,
    cluster (least key). These are the components of the points within that
    distance, which DBSCAN gives with ``min_samples`` 1."""
    points = land(scaled_points(df, key, cols, scale), "scaled")
    out = None
    for t in distances:
        one = dbscan_points(points, t, 1, len(cols)).select(F.col("k").alias(key), F.lit(float(t)).alias("distance"), "cluster")
        out = one if out is None else out.unionByName(one)
    return out
