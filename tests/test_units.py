"""Unit tests with the reference's own fixtures (4-row housing table, known
"""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabkit.functions import bins as B
from tabkit.functions import columns as C
from tabkit.functions import dist as DI
from tabkit.functions import text as TX
from tabkit.operators import features as FE
from tabkit.operators import hypothesis as H
from tabkit.operators import metrics as M
from tabkit.operators import models as MD
from tabkit.operators import order as O
from tabkit.operators import profile as PR
from tabkit.operators import quality as QU


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ---------------------------------------------------------------- P (stateless transformers)

def test_ratio_zero_denominator_and_missing_column(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0), (None, 1.0)], "a double, b double")
    out = C.ratio_features(df, {"r": ("a", "b"), "skip": ("a", "missing")})
    assert "skip" not in out.columns
    assert [r["r"] for r in out.collect()] == [None, 2.0, None]


def test_log_clips_negative_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (math.e - 1,), (None,)], "x double")
    got = [r["log_x"] for r in C.log_features(df, ["x"]).collect()]
    assert got[0] == 0.0 and abs(got[1] - 1.0) < 1e-12 and got[2] is None


def test_polynomial_skips_three_column_spec(spark, housing):
    with pytest.warns(UserWarning):
        out = C.polynomial_features(housing, [["median_income"], ["median_income", "housing_median_age"],
                                              ["a", "b", "c"], ["median_income", "total_rooms", "population"]])
    assert "median_income_sq" in out.columns and "median_income_x_housing_median_age" in out.columns


def test_ordinal_unknown_is_null_and_one_hot_null_all_zero(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    o = C.ordinal_map(df, "c", {"a": 1, "b": 2}, out="o")
    assert [r["o"] for r in o.collect()] == [1, 2, None, None]
    oh = C.one_hot(df, "c", ["a", "b", "z"], drop_first=False)
    assert rows(oh, "c_a", "c_b", "c_z")[-1] == (0, 0, 0)


def test_binary_flag_and_clean_names(spark, housing):
    out = C.binary_flags(housing, [{"column": "ocean_proximity", "value": "INLAND", "new_column": "inland"}])
    assert [r["inland"] for r in out.collect()] == [0, 0, 1, 1]
    assert C.clean_name("Population <1H [x] Total") == "population_lt_1h_(x)_total"


def test_point_distances_argmin_first_on_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    out = C.point_distances(df, "x", "y", {"p": (1.0, 0.0), "q": (0.0, 1.0)})
    r = out.first()
    assert r["dist_min"] == 1.0 and r["nearest"] == "p"


# ---------------------------------------------------------------- M2-M5 semantics

SAMPLE = [1.0, 2.0, 2.0, 3.0, 9.0, 11.0]


def test_bias_corrected_skew_kurtosis(spark):
    df = spark.createDataFrame([(v,) for v in SAMPLE], "x double")
    m = PR.moments(df, ["x"]).first()
    assert abs(m["skew"] - 0.96751) < 1e-5
    assert abs(m["kurt"] - (-1.31363)) < 1e-5
    s = pd.Series(SAMPLE)
    assert abs(m["skew"] - s.skew()) < 1e-12 and abs(m["kurt"] - s.kurt()) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=997) * 10, 1)  # ties included
    grp = rng.integers(0, 3, size=997)
    df = spark.createDataFrame(pd.DataFrame({"g": grp.astype(int), "x": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q_{i}"] for i in range(len(probs))] for r in O.exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g in range(3):
        want = np.quantile(vals[grp == g], probs)
        assert np.allclose(got[g], want, rtol=0, atol=1e-9)
    assert abs(O.quantile_values(spark.createDataFrame([(v,) for v in SAMPLE], "x double"), "x", [0.25])[0] - 2.0) < 1e-12


def test_cut_semantics_right_closed_first_included(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (3.0,)], "x double")
    out = B.fixed_bins(df, "x", [0, 1, 2], ["a", "b"], out="b")
    assert [r["b"] for r in out.collect()] == ["a", "a", "b", "b", None]


def test_qcut_drops_duplicate_edges(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 1.0, 1.0, 2.0, 3.0]], "x double")
    edges = B.quantile_edges(df, "x", 4)
    assert edges == sorted(set(edges)) and edges[0] == 1.0 and edges[-1] == 3.0


def test_average_rank_matches_pandas(spark):
    vals = [3.0, 1.0, 2.0, 2.0, 5.0, 3.0, 3.0, 9.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["x"]: r["rank"] for r in O.average_rank(df, "x", num_partitions=3).collect()}
    want = dict(zip(vals, pd.Series(vals).rank(method="average")))
    assert got == want


def test_prefix_sum_groups_across_partitions(spark):
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 7 + ["c"] * 30, "t": list(range(87)), "w": [1.5] * 87})
    df = spark.createDataFrame(pdf)
    got = O.prefix_sum(df, ["t"], "w", ["g"], num_partitions=7).toPandas().sort_values("t")
    want = pdf.sort_values(["g", "t"]).groupby("g")["w"].cumsum().sort_index()
    assert np.allclose(got["cum"].values, want.values)


def test_ntile_semantics(spark):
    df = spark.range(1, 11).select(F.col("id").alias("pos"))
    out = [r["t"] for r in df.select(O.ntile_from_position(F.col("pos"), F.lit(10), 3).alias("t")).collect()]
    assert out == [1, 1, 1, 1, 2, 2, 2, 3, 3, 3]


# ---------------------------------------------------------------- fitted transformers (V-F)

def test_group_median_imputer_unseen_group_uses_global(spark, housing):
    model = FE.GroupMedianImputer("ocean_proximity", ["total_bedrooms"]).fit(housing)
    out = {r["ocean_proximity"]: r["total_bedrooms"] for r in model.transform(housing).collect()}
    assert out["<1H OCEAN"] == 200.0  # its group has no value: global median of 200, 150, 225
    new = housing.sparkSession.createDataFrame([("ISLAND", None)], "ocean_proximity string, total_bedrooms double")
    assert model.transform(new).first()["total_bedrooms"] == 200.0


def test_group_median_imputer_errors(spark, housing):
    with pytest.raises(FE.NotFittedError):
        FE.GroupMedianImputerModel("ocean_proximity", ["total_bedrooms"], None, None).transform(housing)
    with pytest.raises(ValueError):
        FE.GroupMedianImputer("ocean_proximity", ["no_such"]).fit(housing)


def test_zscore_skips_zero_variance_and_missing(spark, housing):
    df = housing.withColumn("const", F.lit(1.0))
    p = {r["column"]: (r["mean"], r["std"]) for r in FE.fit_zscore(df, ["median_income", "const", "nope"]).collect()}
    assert set(p) == {"median_income"}
    vals = [3.5, 5.0, 7.2, 4.1]
    assert abs(p["median_income"][1] - float(np.std(vals, ddof=1))) < 1e-12


def test_robust_scaler_inverse_roundtrip(spark, housing):
    params = FE.fit_robust(housing, ["median_income"])
    back = FE.apply_affine(FE.apply_affine(housing, params), params, inverse=True)
    assert np.allclose([r["median_income"] for r in back.collect()], [3.5, 5.0, 7.2, 4.1])


# ---------------------------------------------------------------- metrics

def test_regression_metrics_known_values(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 300.0)], "y double, p double")
    m = M.regression_metrics(df, "y", "p").first()
    assert abs(m["rmse"] - math.sqrt(200 / 3)) < 1e-12
    assert abs(m["mae"] - 20 / 3) < 1e-12
    assert abs(m["mape"] - 5.0) < 1e-12
    perfect = M.regression_metrics(df.withColumn("p", F.col("y")), "y", "p").first()
    assert perfect["rmse"] == 0.0 and perfect["r2"] == 1.0


def test_fold_summary_single_fold_std_is_null(spark):
    f = spark.createDataFrame([(0, 10.0)], "fold int, rmse double")
    r = MD.fold_summary(f, ["rmse"]).first()
    assert r["mean"] == 10.0 and r["std"] is None


def test_classification_report_labels_from_truth_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    rep = {r["label"]: r for r in M.classification_report(df, "t", "p").collect()}
    assert rep["c"]["precision"] == 0.0 and rep["c"]["recall"] == 0.0
    assert abs(rep["accuracy"]["f1"] - 0.5) < 1e-12


# ---------------------------------------------------------------- distribution tails and tests

def test_distribution_tails():
    assert abs(DI.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(DI.chi2_sf(5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(DI.t_two_sided(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(DI.f_sf(3.492828476735632, 2, 20) - 0.05) < 1e-9
    assert abs(DI.tukey_sf(3.577935, 3, 20) - 0.05) < 2e-3


def test_erfc_column_approximation(spark):
    xs = [-3.0, -1.0, -0.1, 0.0, 0.3, 1.5, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(DI.erfc_col("x")).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erfc(x)) <= 1.3e-7 * max(math.erfc(x), 1e-300)


def test_mcnemar_continuity(spark):
    data = [(1, 1, 0)] * 10 + [(1, 0, 1)] * 2 + [(1, 1, 1)] * 5
    df = spark.createDataFrame(data, "y int, a int, b int")
    r = H.mcnemar(df, "y", ["a", "b"]).first()
    assert (r["b"], r["c"]) == (10, 2)
    assert abs(r["statistic"] - 49 / 12) < 1e-12
    assert abs(r["p_value"] - math.erfc(math.sqrt(49 / 24))) < 1e-7


def test_chi2_yates_on_2x2(spark):
    data = [("x", "u")] * 12 + [("x", "v")] * 5 + [("y", "u")] * 3 + [("y", "v")] * 10
    df = spark.createDataFrame(data, "a string, b string")
    r = H.chi2_independence(df, "a", "b", yates=True).first()
    obs = np.array([[12, 5], [3, 10]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    d = e - obs
    adj = obs + np.minimum(0.5, np.abs(d)) * np.sign(d)
    assert abs(r["chi2"] - ((adj - e) ** 2 / e).sum()) < 1e-9


def test_kruskal_tie_corrected(spark):
    a, b = [1.0, 2.0, 2.0, 3.0], [2.0, 3.0, 4.0, 5.0, 5.0]
    df = spark.createDataFrame([(v, "a") for v in a] + [(v, "b") for v in b], "x double, g string")
    r = H.kruskal_wallis(df, "x", "g").first()
    allv = pd.Series(a + b)
    rk = allv.rank()
    n = len(allv)
    h = 12 / (n * (n + 1)) * (rk[:4].sum() ** 2 / 4 + rk[4:].sum() ** 2 / 5) - 3 * (n + 1)
    t = allv.value_counts()
    h /= 1 - ((t ** 3 - t).sum()) / (n ** 3 - n)
    assert abs(r["h"] - h) < 1e-12


# ---------------------------------------------------------------- text, quality

def test_text_tokens_fold_and_bigrams(spark):
    df = spark.createDataFrame([("Évacuação é ÚNICA, x2y no  Río!",)], "t string")
    r = df.select(TX.fold_accents("t").alias("f"), TX.tokens("t", min_len=2).alias("k"),
                  TX.word_count("t").alias("w")).first()
    assert r["f"] == "evacuacao e unica, x2y no  rio!"
    assert r["k"] == ["evacuacao", "unica", "no", "rio"]
    assert r["w"] == 6
    b = df.select(TX.bigrams(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("b")).first()["b"]
    assert b == ["a b", "b c"]


def test_rule_detector_negation_window(spark):
    df = spark.createDataFrame([(["no", "x", "fire", "alarm"],), (["fire", "alarm", "fire"],)], "t array<string>")
    pats = [[(["fire"], False), (["alarm"], True)]]
    got = [r[0] for r in df.select(TX.rule_matches(F.col("t"), pats, ["no"])).collect()]
    assert got == [0, 3]  # first: negated; second: (fire alarm), (fire), (fire)


def test_quality_suite_fail_on_error(spark, housing):
    suite = [{"type": "values_between", "column": "housing_median_age", "min": 0, "max": 50},
             {"type": "not_null", "column": "total_bedrooms", "mostly": 0.7}]
    rep = {r["check_id"]: r["success"] for r in QU.run_suite(housing, suite).collect()}
    assert rep == {0: False, 1: True}
    with pytest.raises(QU.QualityError):
        QU.run_suite(housing, suite, fail_on_error=True)


def test_model_factory_unknown_name():
    with pytest.raises(ValueError):
        MD.make_estimator("no_such_model")
    assert MD.make_estimator("ridge").getRegParam() == 1.0


def test_event_time_is_session_zone_independent(spark):
    from tabkit.streaming.monitor import utc_instant
    df = spark.createDataFrame([("2024-01-01 00:00:07",)], "s string").select(F.to_timestamp_ntz("s").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(F.unix_seconds(utc_instant("ts", spark))).first()[0] == 1704067207
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
