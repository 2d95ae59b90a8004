"""Property tests: the range-partitioned prefix sums, average ranks and exact
quantiles agree with pandas/numpy on random data with ties, skewed groups and
many partitions."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from tabkit.operators import order as O

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 400), parts=st.integers(1, 9), hot=st.booleans())
def test_quantiles_and_ranks_match_numpy(spark, seed, n, parts, hot):
    rng = np.random.default_rng(seed)
    vals = rng.integers(0, 25, size=n).astype(float)  # many ties
    grp = np.where(rng.random(n) < (0.8 if hot else 0.3), 0, rng.integers(1, 4, size=n))
    pdf = pd.DataFrame({"g": grp.astype(int), "x": vals})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q_{i}"] for i in range(len(probs))]
           for r in O.exact_quantiles(df, "x", probs, ["g"], num_partitions=parts).collect()}
    for g, sub in pdf.groupby("g"):
        assert np.allclose(got[g], np.quantile(sub["x"].values, probs), atol=1e-9)
    ranks = {r["x"]: r["rank"] for r in O.average_rank(df, "x", num_partitions=parts).collect()}
    want = pd.Series(vals).rank(method="average")
    for v, rk in zip(vals, want):
        assert ranks[v] == rk


@settings(**SETTINGS)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 300), parts=st.integers(1, 9))
def test_grouped_prefix_sum_matches_pandas(spark, seed, n, parts):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, size=n), "t": rng.permutation(n), "w": rng.integers(-5, 10, size=n)})
    got = O.prefix_sum(spark.createDataFrame(pdf), ["t"], "w", ["g"], num_partitions=parts).toPandas()
    want = pdf.sort_values(["g", "t"]).assign(c=lambda d: d.groupby("g")["w"].cumsum())
    m = got.merge(want, on=["g", "t"])
    assert len(m) == n and (m["cum"] == m["c"]).all()


def test_prefix_sum_after_nulls_and_with_large_integers(spark):
    big = 2 ** 60 + 1
    rows = [(t, None if t in (4, 5) else 1, None if t % 3 == 0 else big) for t in range(1, 13)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        df = spark.createDataFrame(rows, "t int, w long, k long")
        got = O.prefix_sum(df, ["t"], "w", num_partitions=1).orderBy("t").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r["cum"] for r in got] == [1, 2, 3, 3, 3, 4, 5, 6, 7, 8, 9, 10]
    assert [r["k"] for r in got] == [r[2] for r in rows]


def test_quantiles_leave_out_nan_and_null(spark):
    df = spark.createDataFrame([(0.0,), (float("nan"),), (1.0,), (2.0,), (None,)], "x double")
    r = O.exact_quantiles(df, "x", [0.5, 1.0]).first()
    assert (r["q_0"], r["q_1"]) == (1.0, 2.0)


@pytest.mark.parametrize("refined", [1, 20, 1_000_000])
def test_quantiles_of_hard_values(spark, monkeypatch, refined):
    """Tails, tiny and huge values, infinities, narrow ranges far from 0; buckets refined down to few rows."""
    monkeypatch.setattr(O, "REFINED_ROWS", refined)
    rng = np.random.default_rng(3)
    groups = {"tail": np.exp(rng.normal(size=400) * 8), "narrow": 1.7e9 + rng.integers(0, 50, 400), "tiny": rng.normal(size=300) * 1e-9,
              "wide": np.array([-1e308, 1e308, 0.0, -5.0, 7.0]), "same": np.full(200, 3.5), "one": np.array([2.0]),
              "inf": np.array([-np.inf, -np.inf, 1.0, 2.0, np.inf, np.inf])}
    data = [(g, float(x)) for g, v in groups.items() for x in v] + [("same", None), ("tail", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q_{i}"] for i in range(5)] for r in O.exact_quantiles(df, "x", probs, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        s = np.sort(v)
        for p, x in zip(probs, got[g], strict=True):
            h = (len(s) - 1) * p
            low, high = s[int(np.floor(h))], s[int(np.ceil(h))]
            want = low if low == high else low + (high - low) * (h - np.floor(h))
            assert x == pytest.approx(want, rel=1e-12, nan_ok=True)


def test_exact_sums_of_large_integers_and_decimals(spark):
    """Values that a double cannot hold, over several ranges, with nulls and a null group."""
    from decimal import Decimal
    data = [(t, (None, "a", "b")[t % 3], 2**55 + t, None if t % 7 == 0 else Decimal(10**20 + t)) for t in range(40)]
    df = spark.createDataFrame(data, "t int, g string, w long, d decimal(30,2)")
    for groups in ([], ["g"]):
        got = {r["t"]: (r["w_cum"], r["d_cum"])
               for r in O.prefix_sum(df, ["t"], ["w", "d"], groups, out=["w_cum", "d_cum"], num_partitions=5).collect()}
        run = {}
        for t, g, w, d in data:
            key = g if groups else 0
            a, b = run.get(key, (0, Decimal(0)))
            run[key] = (a + w, b + (d or 0))
            assert got[t] == run[key]


def test_no_python_in_order_plans(spark):
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(50)], "t int, g int, x double")
    for plan in (O.exact_quantiles(df, "x", [0.5], ["g"]), O.prefix_sum(df, ["t"], "x", ["g"]), O.average_rank(df, "x")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Pandas" not in text and "InArrow" not in text
