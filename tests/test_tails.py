"""p-values of the test tables against tabulated constants and direct formulas; rank correlation with ties and gaps."""

import math

import numpy as np
import pandas as pd
import pytest

from tabkit.functions import dist as DI
from tabkit.operators import hypothesis as H


def test_tails_at_tabulated_points():
    # fixed values: 5 % and 1 % points of the usual tables
    for x, df in ((3.841458820694124, 1), (5.991464547107979, 2), (18.307038053275146, 10)):
        assert DI.chi2_sf(x, df) == pytest.approx(0.05, abs=1e-12)
    for f, a, b in ((4.964602743730711, 1, 10), (3.098391224262598, 3, 20)):
        assert DI.f_sf(f, a, b) == pytest.approx(0.05, abs=1e-9)
    assert DI.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert DI.t_two_sided(2.5758293035489004, 10**9) == pytest.approx(0.01, abs=1e-7)


def test_test_tables_carry_p_values(spark):
    rng = np.random.default_rng(2)
    rows = [(g, float(x)) for g, m in (("a", 0.0), ("b", 0.4), ("c", 0.1)) for x in rng.normal(m, 1, 50)]
    df = spark.createDataFrame([*rows, ("a", None), ("b", float("nan"))], "g string, x double")
    a, k, lv = (f(df, "x", "g").first() for f in (H.anova_oneway, H.kruskal_wallis, H.levene_median))
    # two degrees between groups: the tails are a power and an exponential
    assert a["p_value"] == pytest.approx((147 / (147 + 2 * a["f"])) ** 73.5, rel=1e-9)
    assert lv["p_value"] == pytest.approx((147 / (147 + 2 * lv["w"])) ** 73.5, rel=1e-9)
    assert k["p_value"] == pytest.approx(math.exp(-k["h"] / 2), rel=1e-9)
    for r in (a, k, lv):
        assert r["significance"] == ("significant" if r["p_value"] < 0.05 else "not significant")


def test_correlation_tests(spark):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 6, 90).astype(float), rng.normal(size=90)
    y[:40] = 2.0  # a hot value
    pdf = pd.DataFrame({"x": x, "y": y + x / 4, "c": 1.0})
    pdf.loc[3, "x"] = np.nan
    pdf.loc[5, "y"] = np.nan
    rows = [tuple(None if (i == 3 and j == 0) else float(v) for j, v in enumerate(r)) for i, r in enumerate(pdf.itertuples(index=False))]
    df = spark.createDataFrame(rows, "x double, y double, c double")  # one null, one NaN
    got = {(r["feature"], r["method"]): r for r in H.correlation_tests(df, "y", ["x", "c"]).collect()}
    both = pdf.dropna()
    for method, r in (("pearson", both["x"].corr(both["y"])), ("spearman", both["x"].rank().corr(both["y"].rank()))):
        g = got["x", method]
        assert (g["n"], g["r"]) == (88, pytest.approx(r))
        t = r * math.sqrt(86 / (1 - r * r))
        assert g["p_value"] == pytest.approx(DI.t_two_sided(t, 86), rel=1e-9)
        assert got["c", method]["p_value"] is None
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "x double, y double")
    assert [r["p_value"] for r in H.correlation_tests(line, "y", ["x"], ["spearman"]).collect()] == [0.0]


def test_anderson_darling_keeps_far_rows(spark):
    """One value 44 deviations away: both tails of its neighbours stay finite."""
    x = np.concatenate([np.random.default_rng(1).normal(size=2000), [1e6]])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, x double")
    r = H.anderson_darling(df, "x", ["i"]).first()
    z = (np.sort(x) - x.mean()) / x.std(ddof=1)

    def logcdf(v):
        return math.log(0.5 * math.erfc(-v / math.sqrt(2))) if v > -30 else -v * v / 2 - math.log(-v) - 0.5 * math.log(2 * math.pi)
    n = len(z)
    a2 = -n - sum((2 * i - 1) * (logcdf(z[i - 1]) + logcdf(-z[n - i])) for i in range(1, n + 1)) / n
    assert r["a2"] == pytest.approx(a2, rel=1e-6) and r["reject_5pct"]
