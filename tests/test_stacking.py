"""Stacking: out-of-fold rows, ridge and balanced meta-models against direct computations."""

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabkit.operators import stacking as ST
from tabkit.operators.split import key_hash


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] ** 2 + rng.normal(size=150) * 0.1
    rows = [(i, float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame([*rows, (999, 0.0, 0.0, None)], "id long, a double, b double, y double").repartition(3)


def line(inputs, name):
    return ST.Base(name, LinearRegression(labelCol="y", regParam=0.0, solver="normal"), inputs)


@pytest.mark.parametrize("alpha", [0.0, 25.0])
def test_ridge_stack_equals_direct_fits(data, alpha):
    model = ST.fit_stacking(data, ["id"], "y", [line(["a"], "p"), line(["b"], "r")], 3, alpha)
    rows = data.where("y IS NOT NULL").withColumn("fold", F.pmod(key_hash(F.concat_ws("|", "id")), F.lit(3))).orderBy("id").collect()
    a, b, y, fold = (np.array([r[c] for r in rows], float) for c in ("a", "b", "y", "fold"))
    held = np.zeros((len(y), 2))
    for j, x in enumerate((a, b)):
        for k in range(3):
            slope, start = np.polyfit(x[fold != k], y[fold != k], 1)
            held[fold == k, j] = slope * x[fold == k] + start
    got = {r["id"]: (r["p"][0], r["r"][0]) for r in model.out_of_fold.collect()}
    assert len(got) == len(y)
    assert all(got[r["id"]] == pytest.approx(tuple(h), rel=1e-6) for r, h in zip(rows, held, strict=True))
    c = held - held.mean(axis=0)
    w = np.linalg.solve(c.T @ c + alpha * np.eye(2), c.T @ (y - y.mean()))
    assert model.meta.coefficients.toArray() == pytest.approx(w, rel=1e-4)
    full = np.column_stack([np.polyval(np.polyfit(x, y, 1), x) for x in (a, b)])
    want = y.mean() + (full - held.mean(axis=0)) @ w
    out = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    assert [out[r["id"]] for r in rows] == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert 999 in out  # rows without a label are predicted, not fitted


def test_balanced_fusion_of_probabilities(spark):
    rng = np.random.default_rng(5)
    label = (rng.random(300) < 0.15).astype(float)
    rows = [(i, float(v + rng.normal() * 0.6), float(v + rng.normal()), float(v)) for i, v in enumerate(label)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    bases = [ST.Base(f"by_{n}", NaiveBayes(modelType="gaussian", labelCol="y"), [n], "probability") for n in ("a", "b")]
    model = ST.fit_stacking(df, ["id"], "y", bases, 3, classify=True)
    out = model.transform(df).collect()
    assert all(sum(r["probability"]) == pytest.approx(1) for r in out)
    recall = np.mean([r["prediction"] for r in out if r["y"] == 1])
    assert recall > 0.6  # the rare class is not ignored
    assert np.mean([r["prediction"] == r["y"] for r in out]) > 0.7
    with pytest.raises(ValueError):
        ST.fit_stacking(df, ["id"], "y", [ST.Base("a", NaiveBayes(labelCol="y"), ["b"])])
