"""Density clustering and neighbours against direct computations, with crowded cells and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import density as D
from tabkit.operators import graph
from tabkit.operators import neighbours as NN


def direct_dbscan(points, eps, least):
    n = len(points)
    near = ((points[:, None] - points[None]) ** 2).sum(-1) <= eps ** 2
    core, label, c = near.sum(1) >= least, np.full(n, -1), 0
    for i in range(n):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] == -1:
                label[j] = c
                if core[j]:
                    stack += [k for k in np.flatnonzero(near[j]) if label[k] == -1]
        c += 1
    return label


def frame(spark, points):
    cols = [f"x{i}" for i in range(points.shape[1])]
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                                 "id long, " + ", ".join(f"{c} double" for c in cols)).repartition(3), cols


@pytest.mark.parametrize("case,dim,eps,least", [("blobs", 2, 0.3, 6), ("crowded", 2, 0.15, 5), ("space", 3, 0.5, 4)])
@pytest.mark.parametrize("pairs_per_row", [50, 0])
def test_dbscan(spark, monkeypatch, case, dim, eps, least, pairs_per_row):
    """With 0 pairs a row, nodes are cut to the last level before rows are compared."""
    monkeypatch.setattr(D, "PAIRS_PER_ROW", pairs_per_row)
    monkeypatch.setattr(D, "MOST_CUTS", 2)
    rng = np.random.default_rng(dim)
    p = np.concatenate([rng.normal(size=(60, dim)) * 0.5, rng.normal(size=(60, dim)) * 0.6 + 3])
    if case == "crowded":  # a cell with half of the rows, copies, points on a lattice
        p = np.concatenate([p, np.tile(p[:1], (60, 1)), p[:1] + rng.normal(size=(60, dim)) * 0.01, np.round(p[:50], 1)])
    p = rng.permutation(p)
    df, cols = frame(spark, p)
    scores, labels = D.dbscan(df, "id", cols, [eps], least, scale=False)
    want = direct_dbscan(p, eps, least)
    got = {r["id"]: r["cluster"] for r in labels.collect()}
    assert [got[i] for i in range(len(p))] == want.tolist()
    s = scores.first()
    assert (s["n_clusters"], s["n_noise"]) == (want.max() + 1, (want == -1).sum())


def test_points_on_one_line_and_equal_points(spark):
    p = np.array([[0.0, 0.0]] * 5 + [[1.0, 0.0]] * 5 + [[2.0, 0.0], [9.0, 0.0]])
    df, cols = frame(spark, p)
    scores, labels = D.dbscan(df, "id", cols, [1.0, 0.5], 5, scale=False)
    by = {(r["eps"], r["id"]): r["cluster"] for r in labels.collect()}
    assert [by[1.0, i] for i in range(12)] == [0] * 11 + [-1]  # distance 1 is within 1; the last but one is a border point
    assert [by[0.5, i] for i in range(12)] == [0] * 5 + [1] * 5 + [-1, -1]
    assert [r["silhouette"] for r in scores.orderBy("eps").collect()] == [1.0, None]
    assert [r["best"] for r in scores.orderBy("eps").collect()] == [True, False]


def test_dbscan_leaves_out_incomplete_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, float("nan"), 0.0), (5, float("inf"), 0.0)],
                               "id long, x0 double, x1 double")
    scores, labels = D.dbscan(df, "id", ["x0", "x1"], [0.2], 2, scale=False, silhouette="squared")
    assert {r["id"]: r["cluster"] for r in labels.collect()} == {1: 0, 2: 0}
    empty_scores, empty_labels = D.dbscan(df.where("id > 9"), "id", ["x0", "x1"], [0.2], 2)
    assert (empty_scores.first()["n_clusters"], empty_scores.first()["silhouette"], empty_labels.count()) == (0, None, 0)
    with pytest.raises(ValueError):
        D.Grid(1.0, 5)


def test_single_linkage_is_chaining(spark):
    df, cols = frame(spark, np.array([[0.0], [1.0], [2.0], [4.0], [5.5]]))
    got = {(r["distance"], r["id"]): r["cluster"] for r in D.single_linkage_cut(df, "id", cols, [1.0, 1.5, 2.0], scale=False).collect()}
    assert [got[1.0, i] for i in range(5)] == [0, 0, 0, 3, 4]
    assert [got[1.5, i] for i in range(5)] == [0, 0, 0, 3, 3]
    assert [got[2.0, i] for i in range(5)] == [0] * 5


def test_components_of_long_paths(spark):
    nodes = spark.range(300).select(F.col("id").alias("node"))
    edges = spark.range(299).where("id <> 149").select((299 - F.col("id")).alias("a"), (298 - F.col("id")).alias("b"))
    got = {r["node"]: r["label"] for r in graph.components(nodes, edges).collect()}
    assert got == {i: 0 if i < 150 else 150 for i in range(300)}


VECTORS = "id long, v array<float>, label int, dist string"


def direct_neighbours(base, queries, k):
    out = set()
    for q, v in queries:
        d = sorted((float(np.sqrt(((np.array(v, np.float32).astype(float) - np.array(w, np.float32).astype(float)) ** 2).sum())), b)
                   for b, w in base)
        out |= {(q, b, r) for r, (_, b) in enumerate(d[:k], 1)}
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(6, 8)) * 3
    data = [(i, [float(x) for x in centre[i % 6] + rng.normal(size=8) * 0.5]) for i in range(240)]
    return data + [(1000 + i, data[0][1]) for i in range(120)]  # a third of the rows is one vector


@pytest.mark.parametrize("block_rows", [20_000, 37])
def test_exact_neighbours(spark, vectors, block_rows):
    rows = [(i, v, i % 6, "d") for i, v in vectors] + [(5000, None, 0, "d"), (5001, [], 0, "d"), (5002, [float("nan")] * 8, 0, "d")]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    found = NN.exact_neighbours(df, df.where("id % 20 = 0"), "id", "v", 5, ("label",), block_rows)
    queries = [(i, v) for i, v in vectors if i % 20 == 0]
    assert {(r["query"], r["base"], r["rank"]) for r in found.collect()} == direct_neighbours(vectors, queries, 5)
    few = NN.exact_neighbours(df.where("id < 3"), df.where("id = 20"), "id", "v", 5).collect()
    assert len(few) == 3
    assert NN.exact_neighbours(df.where("id < 0"), df, "id", "v", 5).collect() == []


@pytest.mark.parametrize("block_rows", [20_000, 25])
def test_list_neighbours(spark, vectors, block_rows):
    df = spark.createDataFrame([(i, v, i % 6, "d") for i, v in vectors], VECTORS).repartition(4)
    queries = df.where("id % 20 = 0")
    index = NN.fit_lists(df, "id", "v", k=5, lists=12)
    assert 1 <= index.probes <= 12
    found = NN.list_neighbours(df, queries, "id", "v", index, 5, (), block_rows)
    r = NN.recall_of(found, NN.exact_neighbours(df, queries, "id", "v", 5)).first()
    assert r["n_queries"] == queries.count() and r["recall"] >= 0.9
    # every list: exact
    whole = NN.list_neighbours(df, queries, "id", "v", NN.Lists(index.centroids, 12), 5, ("label",), block_rows)
    assert {(x["query"], x["base"]) for x in whole.collect()} == {
        (q, b) for q, b, _ in direct_neighbours(vectors, [(i, v) for i, v in vectors if i % 20 == 0], 5)}
    nothing = NN.fit_lists(df.where("id < 0"), "id", "v")
    assert NN.list_neighbours(df.where("id < 0"), queries.where("id < 0"), "id", "v", nothing, 5).collect() == []
