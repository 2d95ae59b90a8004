"""Windows over blocks against pandas: short blocks, hot and null series, reaches longer than a block."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabkit.operators import timeseries as TS


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    series = np.where(rng.random(120) < 0.6, "hot", rng.choice(["a", "b"], 120)).astype(object)
    series[:5] = None
    pdf = pd.DataFrame({"t": rng.permutation(120), "s": series, "x": rng.integers(0, 50, 120).astype(float)})
    pdf.loc[7, "x"] = np.nan
    rows = [(int(t), s, None if np.isnan(x) else float(x)) for t, s, x in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "t int, s string, x double"), pdf.sort_values("t")


@pytest.mark.parametrize("parts", [1, 4, 40])
@pytest.mark.parametrize("back,ahead", [(1, 1), (3, 0), (0, 4), (11, 7)])
def test_halo_holds_every_neighbour(frame, parts, back, ahead):
    df, pdf = frame
    rows, w = TS.with_halo(df, ["t"], ["s"], back, ahead, num_partitions=parts)
    got = rows.withColumn("near", F.collect_list("t").over(w.rowsBetween(-back, ahead))).where("NOT _halo").collect()
    assert len(got) == len(pdf)
    for s, g in pdf.groupby("s", dropna=False):
        t = g["t"].tolist()
        mine = {r["t"]: r for r in got if r["s"] == s or (r["s"] is None and not isinstance(s, str))}
        for i, v in enumerate(t):
            assert mine[v]["_pos"] == i + 1
            assert mine[v]["near"] == t[max(0, i - back):i + ahead + 1]


def test_operators_match_pandas(frame):
    df, pdf = frame
    named = pdf[pdf["s"].notna()]
    by = named.groupby("s")["x"]
    want = named.assign(d=by.diff(), r=by.transform(lambda v: v.rolling(4, min_periods=1).mean()), p=by.shift(2), n=by.shift(-1))
    want = want.set_index("t").replace({np.nan: None})
    for op, col, w in ((TS.difference(df, "x", ["t"], ["s"]), "x_diff", "d"), (TS.rolling_mean(df, "x", ["t"], 4, ["s"]), "x_roll4", "r")):
        for r in op.where("s IS NOT NULL").collect():
            x = want.loc[r["t"], w]
            assert (r[col] is None) == (x is None) and (x is None or r[col] == pytest.approx(x))
    both = {r["t"]: (r["x_x"], r["x_y"]) for r in TS.lag_lead(df, "x", ["t"], ["s"], 2, 1, False).where("s IS NOT NULL").collect()}
    assert both == {t: (r.p, r.n) for t, r in want.iterrows()}
    sizes = named.groupby("s").size()
    assert TS.lag_lead(df, "x", ["t"], ["s"], 2, 1).where("s IS NOT NULL").count() == int((sizes - 3).clip(lower=0).sum())


def test_past_windows_and_autocorrelation(frame, spark):
    df, pdf = frame
    rows = TS.past_windows(df.where("s = 'hot'"), "x", ["t"], past=3, future=2, target="t").collect()
    hot = pdf[pdf["s"] == "hot"]
    t, x = hot["t"].tolist(), [None if np.isnan(v) else v for v in hot["x"]]
    assert {r["t"]: (r["window"], r["y"]) for r in rows} == {t[i]: (x[i - 3:i], t[i + 1]) for i in range(3, len(t) - 1)}
    v = np.random.default_rng(1).normal(size=60)
    series = spark.createDataFrame([(i, float(a)) for i, a in enumerate(v)], "t int, x double")
    c = v - v.mean()
    got = {r["k"]: r["acf"] for r in TS.autocorrelation(series, "x", ["t"], 5).collect()}
    assert got == {k: pytest.approx(float((c[:60 - k] * c[k:]).sum() / (c * c).sum())) for k in range(6)}
