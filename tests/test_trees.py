"""Trees on cells against MLlib's trees on rows."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tabkit.operators import trees as TR

FEATS = ["a", "b", "c", "d"]


def table(spark, n=3000, seed=5):
    """Many values, a crowded value, few values, one value."""
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), np.where(rng.random(n) < 0.4, 7.0, np.round(rng.random(n) * 30))
    c, d = rng.integers(-1, 4, n), np.full(n, 3.0)
    y = 10 * np.sin(2 * a) + b * (c == 2) + c + rng.normal(size=n)
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c, d, y)], "a double, b double, c double, d double, label double")


def assembled(df):
    return VectorAssembler(inputCols=FEATS, outputCol="features").transform(df)


def by_turns(x, bins):
    """MLlib's findSplitsForContinuousFeature over all values."""
    v, c = np.unique(x, return_counts=True)
    if len(v) <= bins:
        return [(p + q) / 2 for p, q in zip(v, v[1:])]
    out, stride, upto = [], len(x) / bins, c[0]
    target = stride
    for i in range(1, len(v)):
        before, upto = upto, upto + c[i]
        if abs(before - target) < abs(upto - target):
            out.append((v[i - 1] + v[i]) / 2)
            target += stride
    return out


@pytest.mark.parametrize("many, parts", [(10_000, 1_024), (60, 64), (60, 200)])
def test_split_points_follow_the_rule(spark, monkeypatch, many, parts):
    monkeypatch.setattr(TR, "MANY", many)
    monkeypatch.setattr(TR, "PARTS", parts)
    rng = np.random.default_rng(parts)
    n = 1200
    cols = {"plain": rng.normal(size=n), "tail": np.exp(3 * rng.normal(size=n)).round(1), "few": rng.integers(0, 50, n),
            "fewer": rng.integers(-2, 3, n), "one": np.full(n, 3.0), "half": np.r_[np.zeros(n // 2), 1 + np.arange(n - n // 2)],
            "crowds": np.r_[np.full(n // 6, 1.0), np.full(n // 6, 1.5), np.full(n // 6, 1.6), 2 * rng.random(n - 3 * (n // 6))]}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    got = TR.split_points(df.repartition(3), list(cols))
    for name, x in cols.items():
        assert got[name] == by_turns(np.asarray(x, float), 32), name


def test_trees_on_cells_are_the_trees_on_rows(spark):
    df = table(spark)
    rows, cells = assembled(df), TR.tree_cells(df.repartition(3), FEATS, "label")
    assert cells.agg(F.sum("rows")).first()[0] == 3000 and cells.count() < 3000
    v, most = assembled(cells), TR.candidates_param(cells)
    within = cells.agg(F.sum("within") / F.sum("rows")).first()[0]
    for kind, params in [(DecisionTreeRegressor, {"maxDepth": 6}), (GBTRegressor, {"maxIter": 5})]:
        want, got = kind(**params).fit(rows), kind(weightCol="rows", maxBins=most, **params).fit(v)
        assert np.allclose(want.featureImportances.toArray(), got.featureImportances.toArray(), atol=1e-9)
        err = RegressionEvaluator(weightCol="rows").evaluate(got.transform(v))
        assert math.isclose(RegressionEvaluator().evaluate(want.transform(rows)), math.sqrt(err * err + within), rel_tol=1e-9)


def test_all_bins_of_many_cells_are_candidates(spark):
    """MLlib looks for bins in about 10,000 instances; a rare one is missed unless all count."""
    rows = [(float(i % 150), float(i // 150), float(i == 5), 0.0, float(i == 5)) for i in range(22_500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double")
    cells = spark.createDataFrame([(*r[:4], 1, r[4]) for r in rows], "a double, b double, c double, d double, rows long, label double")
    assert TR.split_points(df, ["c", "d"]) == {"c": [0.5], "d": []}
    m = DecisionTreeRegressor(maxDepth=1, weightCol="rows", maxBins=TR.candidates_param(cells)).fit(assembled(cells))
    assert m.featureImportances.toArray().tolist() == [0.0, 0.0, 1.0, 0.0]


def test_regressors_pass_over_cells_not_rows(spark, tmp_path, monkeypatch):
    from tabkit.operators import models as MD
    from tabkit.plans import ml_plans as P
    n = 4000
    li = [(i, i % 5, i % 40, i % 9, float(i % 4), (i % 3) / 100, (i % 2) / 100, float(1000 + (i * i) % 700 + 90 * (i % 4))) for i in range(n)]
    spark.createDataFrame(li, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                              "l_discount double, l_tax double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, float(900 + k % 4), k % 2) for k in range(40)],
                          "p_partkey long, p_retailprice double, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen, make = [], MD.make_estimator

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, d):
            seen.append((d.count(), d.agg(F.sum("rows")).first()[0]))
            return self.inner.fit(d)
    d = VectorAssembler(inputCols=P.FEATS, outputCol="features").transform(P._li_features(P.Tables(spark, str(tmp_path))))
    want = {k: RegressionEvaluator().evaluate(make(k, **p).fit(d).transform(d))
            for k, p in [("decision_tree_regressor", {"maxDepth": 6}), ("gbt_regressor", {"maxIter": 20}),
                         ("random_forest_regressor", {"numTrees": 20, "seed": 13})]}
    monkeypatch.setattr(MD, "make_estimator", lambda *a, **k: Watched(make(*a, **k)))
    got = {r["model"]: r["rmse"] for r in P.a05(spark, str(tmp_path)).collect()}
    assert len(seen) == 3 and all(cells <= 400 and rows == n for cells, rows in seen), seen
    for k in ("decision_tree_regressor", "gbt_regressor"):
        assert math.isclose(got[k], want[k], rel_tol=1e-9)
    assert math.isclose(got["random_forest_regressor"], want["random_forest_regressor"], rel_tol=0.02)


def test_bags_draw_single_rows(spark):
    draws = np.array([TR.poisson_ones(np.arange(40_000), k) for k in range(4)])
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02 and np.abs(np.corrcoef(draws) - np.eye(4)).max() < 0.02
    seen = np.bincount(draws.ravel(), minlength=5)[:5] / draws.size
    assert np.abs(seen - [math.exp(-1) / math.factorial(k) for k in range(5)]).max() < 0.005
    one = spark.range(0, 2000, 1, 2).select(*[F.lit(1.0).alias(c) for c in FEATS], (F.col("id") % 7).cast("double").alias("label"))
    bags = TR.tree_cells(one, FEATS, "label", bags=2, seed=3).toPandas()
    for k in (0, 1):
        w, y = bags[f"bag{k}_rows"], bags[f"bag{k}_label"]
        assert abs(w.sum() - 2000) < 300 and abs((w * y).sum() / w.sum() - 3) < 0.3
    assert (bags["bag0_label"] != bags["bag1_label"]).all() and (bags["bag0_label"] != bags["label"]).all()


def test_forest_of_bags(spark):
    df = table(spark)
    cells = TR.tree_cells(df, FEATS, "label", bags=12, seed=13)
    v = assembled(cells)
    est = TR.BaggedForestRegressor(numTrees=12, seed=13, weightCol="rows", maxBins=TR.candidates_param(cells))
    m = est.fit(v)
    assert m.getNumTrees == 12 and len({t.toDebugString.split("\n", 1)[1] for t in m.trees}) == 12
    assert {t.depth for t in m.trees} == {5} and abs(sum(m.featureImportances.toArray()) - 1) < 1e-9
    plain = [RandomForestRegressor(numTrees=12, seed=s).fit(assembled(df)) for s in (1, 2, 3)]
    within = cells.agg(F.sum("within") / F.sum("rows")).first()[0]
    err = RegressionEvaluator(weightCol="rows").evaluate(m.transform(v))
    wants = [RegressionEvaluator().evaluate(p.transform(assembled(df))) for p in plain]
    assert abs(math.sqrt(err * err + within) / np.mean(wants) - 1) < 0.1
    shares = np.mean([p.featureImportances.toArray() for p in plain], axis=0)
    assert np.abs(m.featureImportances.toArray() - shares).max() < 0.1
    # tables without bags go to MLlib
    rows = TR.BaggedForestRegressor(numTrees=12, seed=1).fit(assembled(df))
    assert np.allclose(rows.featureImportances.toArray(), plain[0].featureImportances.toArray())
    with pytest.raises(ValueError, match="bags"):
        TR.BaggedForestRegressor(numTrees=13, seed=13, weightCol="rows").fit(v)


@pytest.mark.parametrize("row, what", [((None, 1.0), "null"), ((float("nan"), 1.0), "null"), ((1.0, None), "label"),
                                       ((1.0, float("inf")), "label")])
def test_cells_refuse_what_trees_refuse(spark, row, what):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), row], "a double, label double")
    with pytest.raises(ValueError, match=what):
        TR.tree_cells(df, ["a"], "label")
    with pytest.raises(ValueError, match="no rows"):
        TR.tree_cells(df.limit(0), ["a"], "label")


def test_infinite_features_are_extremes(spark):
    rows = [(float("inf") if i % 5 == 0 else float("-inf") if i % 5 == 1 else float(i), float(i % 5)) for i in range(40)]
    cells = TR.tree_cells(spark.createDataFrame(rows, "a double, label double"), ["a"], "label", max_bins=4)
    got = cells.agg(F.sum("rows").alias("n"), F.min("label").alias("least")).first()
    assert got["n"] == 40 and got["least"] >= 0
    assert sum(r["rows"] for r in cells.where("a = 0").collect()) >= 8
