"""Plans for fitted transformers (V-F), clustering (L), models (A) and search (Z)."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import bins as B
from ..operators import cluster as CL
from ..operators import features as FE
from ..operators import models as MD
from ..operators import split as S
from ..operators import trees as TR
from ..operators.order import land
from ..streaming.monitor import scratch_dir
from .registry import Tables, plan, rnd


def _disc_null(t: Tables):
    """lineitem with a null path: discount 0 -> null."""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity",
                             "l_extendedprice", "l_tax", F.expr("nullif(l_discount, 0)").alias("disc"))


LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@plan("vf01_group_median_imputer", "V-F01", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, nullif(l_discount, 0) AS disc FROM lineitem),
m AS (SELECT l_returnflag, median(disc) AS gm FROM b GROUP BY 1), g AS (SELECT median(disc) AS glob_m FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(disc, gm, glob_m), 9) AS disc FROM b LEFT JOIN m USING (l_returnflag) CROSS JOIN g""")
def vf01(spark, sf_dir):
    d = _disc_null(Tables(spark, sf_dir))
    model = FE.GroupMedianImputer("l_returnflag", ["disc"]).fit(d)
    return model.transform(d).select(*LI_KEYS, rnd("disc", 9).alias("disc"))


@plan("vf02_median_imputer", "V-F02", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_discount, 0) AS disc FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(disc, (SELECT median(disc) FROM b)), 9) AS disc FROM b""")
def vf02(spark, sf_dir):
    d = _disc_null(Tables(spark, sf_dir))
    med = FE.fit_median_imputer(d, ["disc"], exact=True)
    return FE.impute(d, med).select(*LI_KEYS, rnd("disc", 9).alias("disc"))


@plan("vf03_zscore_scaler", "V-F03,M8", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - mq) / sq, 9) + 0.0 AS l_quantity,
  round((l_tax - mt) / st, 9) + 0.0 AS l_tax, 1.0::DOUBLE AS const FROM lineitem, s""")
def vf03(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(*LI_KEYS, "l_quantity", "l_tax", F.lit(1.0).alias("const"))
    params = FE.fit_zscore(li, ["l_quantity", "l_tax", "const", "missing_col"])  # const (zero variance) skipped
    out = FE.apply_affine(li, params)
    return out.select(*LI_KEYS, rnd("l_quantity", 9).alias("l_quantity"), rnd("l_tax", 9).alias("l_tax"), "const")


@plan("vf04_robust_scaler_inverse", "V-F04,M15", """
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - q[2]) / (q[3] - q[1]), 9) + 0.0 AS scaled,
  round(l_extendedprice, 4) AS restored FROM lineitem, q""")
def vf04(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(*LI_KEYS, "l_extendedprice")
    params = FE.fit_robust(li, ["l_extendedprice"])
    scaled = FE.apply_affine(li, params)
    back = FE.apply_affine(scaled.withColumnRenamed("l_extendedprice", "x").withColumn("l_extendedprice", F.col("x")),
                           params, inverse=True)
    return back.select(*LI_KEYS, rnd("x", 9).alias("scaled"), rnd("l_extendedprice", 4).alias("restored"))


@plan("vf04_mllib_scalers", "V-F04")
def vf04b(spark, sf_dir):
    from pyspark.ml.feature import MinMaxScaler
    li = Tables(spark, sf_dir).lineitem
    v = VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol="x").transform(li)
    std = StandardScaler(inputCol="x", outputCol="std", withMean=True, withStd=True).fit(v)
    mm = MinMaxScaler(inputCol="x", outputCol="mm").fit(v)
    out = mm.transform(std.transform(v))
    return out.select(*LI_KEYS, vector_to_array("std").alias("std"), vector_to_array("mm").alias("mm"))


@plan("vf05_power_transforms", "V-F05")
def vf05(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    lam_yj = FE.fit_power(o, "o_totalprice", "yeo-johnson", lo=-1.0, hi=1.0)
    lam_bc = FE.fit_power(o, "o_totalprice", "box-cox", lo=-1.0, hi=1.0)
    out = FE.apply_power(o, "o_totalprice", lam_yj, "yeo-johnson", out="yj")
    out = FE.apply_power(out, "o_totalprice", lam_bc, "box-cox", out="bc")
    return out.select("o_orderkey", "yj", "bc", F.lit(lam_yj).alias("lambda_yj"), F.lit(lam_bc).alias("lambda_bc"))


def _kbins_sql(k=5):
    probs = ", ".join(str(i / k) for i in range(k + 1))
    cases = " ".join((f"WHEN x >= q[{i + 1}] AND x <= q[{i + 2}] THEN {i}" if i == 0 else
                      f"WHEN x > q[{i + 1}] AND x <= q[{i + 2}] THEN {i}") for i in range(k))
    return f"""WITH e AS (SELECT quantile_cont(l_extendedprice, [{probs}]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE {cases} END AS INTEGER) AS kbin
FROM (SELECT *, l_extendedprice AS x FROM lineitem), e"""


@plan("vf06_kbins_quantile", "V-F06,P09", _kbins_sql())
def vf06(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out, _ = B.quantile_bins(li, "l_extendedprice", 5, as_index=True, out="kbin")
    return out.select(*LI_KEYS, F.col("kbin").cast("int").alias("kbin"))


@plan("vf08_column_pipeline", "V-F08,V-F07,X09")
def vf08(spark, sf_dir):
    from pyspark.ml.feature import CountVectorizer, IDF, OneHotEncoder, StringIndexer
    from ..functions.text import tokens
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "n_chars", tokens("text", 2).alias("toks"))
    stages = [CountVectorizer(inputCol="toks", outputCol="tf", vocabSize=5000, minDF=3.0),
              IDF(inputCol="tf", outputCol="tfidf"),
              StringIndexer(inputCol="lang", outputCol="lang_i", handleInvalid="keep"),
              OneHotEncoder(inputCols=["lang_i"], outputCols=["lang_oh"], dropLast=True, handleInvalid="keep"),
              VectorAssembler(inputCols=["n_chars"], outputCol="num"),
              StandardScaler(inputCol="num", outputCol="num_s"),
              VectorAssembler(inputCols=["tfidf", "lang_oh", "num_s"], outputCol="features")]
    m = Pipeline(stages=stages).fit(d)
    out = m.transform(d)
    return out.select("doc_id", F.size(vector_to_array("features")).alias("n_features"))


VF09_CONFIG = {
    "binary_flags": [{"column": "l_returnflag", "value": "R", "new_column": "is_returned"}],
    "ratios": {"unit_price": ("l_extendedprice", "l_quantity")},
    "logs": ["l_extendedprice"],
    "polynomial": [["l_quantity"], ["l_quantity", "l_discount"]],
    "one_hot": [{"column": "l_linestatus", "values": ["F", "O"], "prefix": "status", "drop_first": True}],
    "select": LI_KEYS + ["is_returned", "unit_price", "log_l_extendedprice", "l_quantity_sq",
                         "l_quantity_x_l_discount", "status_O", "missing_feature"],
    "fill_missing": 0.0,
}


@plan("vf09_stateless_pipeline", "V-F09,P01,P02,P06,P07,P11,P12", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(coalesce(l_returnflag = 'R', false) AS INTEGER) AS is_returned,
  round(l_extendedprice / l_quantity, 6) AS unit_price, round(ln(1 + l_extendedprice), 9) AS log_l_extendedprice,
  round(pow(l_quantity, 2), 6) AS l_quantity_sq, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
  CAST(coalesce(l_linestatus = 'O', false) AS INTEGER) AS status_O, 0.0::DOUBLE AS missing_feature FROM lineitem""")
def vf09(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = FE.stateless_pipeline(li, VF09_CONFIG)
    return out.select(*LI_KEYS, "is_returned", rnd("unit_price", 6).alias("unit_price"),
                      rnd("log_l_extendedprice", 9).alias("log_l_extendedprice"), rnd("l_quantity_sq", 6).alias("l_quantity_sq"),
                      rnd("l_quantity_x_l_discount", 6).alias("l_quantity_x_l_discount"), "status_O", "missing_feature")


def _li_features(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size")
    return t.lineitem.join(part, "l_partkey").select(*LI_KEYS, "l_quantity", "l_discount", "l_tax", "p_retailprice",
                                                     "p_size", F.col("l_extendedprice").alias("label"))


FEATS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


@plan("vf10_leak_free_cv", "V-F10,Z01,Z03,B06,A01,A02")
def vf10(spark, sf_dir):
    from pyspark.ml.tuning import ParamGridBuilder
    from ..functions.columns import scalars
    t = Tables(spark, sf_dir)
    d = _li_features(t)
    key = F.concat_ws("|", *LI_KEYS)
    d = d.select(*FEATS, "label", F.pmod(S.key_hash(key), F.lit(3)).cast("int").alias("fold"))
    lr = MD.make_estimator("ridge", featuresCol="features", labelCol="label")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True), lr])
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 1.0, 10.0]).build()
    cvm = MD.cross_validate(pipe, grid, d, RegressionEvaluator(metricName="rmse"), fold_col="fold", parallelism=3)
    maps = [{"regParam": p} for p in [0.0, 1.0, 10.0]]
    return MD.cv_results_table(spark, cvm, maps, "ridge")


@plan("vf11_univariate_selection", "V-F11,H03")
def vf11(spark, sf_dir):
    from pyspark.ml.feature import UnivariateFeatureSelector
    e = CL.as_vectors(Tables(spark, sf_dir).embeddings, "embedding").withColumn("label", F.col("label").cast("double"))
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="sel",
                                    selectionMode="numTopFeatures").setFeatureType("continuous").setLabelType("categorical")
    sel.setSelectionThreshold(8)
    m = sel.fit(e)
    return spark.createDataFrame([(int(i),) for i in m.selectedFeatures], "feature int")


@plan("vf12_recursive_elimination", "V-F12")
def vf12(spark, sf_dir):
    from pyspark.ml.regression import LinearRegression
    d = _li_features(Tables(spark, sf_dir))
    feats = list(FEATS)
    rows = []
    while len(feats) > 2:
        v = VectorAssembler(inputCols=feats, outputCol="raw").transform(d)
        v = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(v).transform(v)
        m = LinearRegression(labelCol="label").fit(v)
        coefs = [abs(c) for c in m.coefficients.toArray()]
        drop = feats[coefs.index(min(coefs))]
        rows.append((len(feats), drop, float(m.summary.rootMeanSquaredError)))
        feats.remove(drop)
    return spark.createDataFrame(rows, "n_features int, dropped string, rmse double")


@plan("vf13_pca", "V-F13,Q09")
def vf13(spark, sf_dir):
    e = CL.as_vectors(Tables(spark, sf_dir).embeddings, "embedding")
    _, var, load, _ = FE.pca_tables(e, "features", 10)
    k95 = FE.components_for_share(var, 0.5)
    return var.withColumn("k_for_half", F.lit(k95))


@plan("vf14_random_fourier_pca", "V-F14,A04")
def vf14(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    r = FE.random_fourier(e, "embedding", 64, 100, gamma=0.05)
    r = CL.as_vectors(r, "rff")
    _, var, _, _ = FE.pca_tables(r, "features", 5)
    return var


@plan("vf15_lda_projection", "V-F15")
def vf15(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    proj, evals = FE.lda_projection(e, "embedding", "label", k=2)
    return proj.select("vec_id", "label", "lda")


@plan("vf16_tfidf_svd", "V-F16,X09")
def vf16(spark, sf_dir):
    from ..operators.textops import tfidf
    d = Tables(spark, sf_dir).documents
    tf = tfidf(d, "doc_id", "text", min_df=3, max_features=2000)
    return FE.tfidf_svd(tf, "doc_id", k=2)


# ---------------------------------------------------------------- clustering (L)

@plan("l01_kmeans_grid", "L01,L05")
def l01(spark, sf_dir):
    e = CL.as_vectors(Tables(spark, sf_dir).embeddings, "embedding")
    return CL.kmeans_grid(e, "features", [2, 3, 4, 5, 6])


@plan("l02_kmeans_labels", "L02")
def l02(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_size", (F.col("p_retailprice") / 100).alias("price"))
    return CL.kmeans_labels(p, "p_partkey", ["p_size", "price"], 3)


@plan("l04_bisecting_kmeans", "L04")
def l04(spark, sf_dir):
    e = CL.as_vectors(Tables(spark, sf_dir).embeddings, "embedding")
    return CL.bisecting(e, "features", [2, 4, 6])


@plan("l05_given_label_scores", "L05")
def l05(spark, sf_dir):
    from pyspark.ml.evaluation import ClusteringEvaluator
    e = Tables(spark, sf_dir).embeddings
    v = CL.as_vectors(e, "embedding").withColumn("prediction", F.col("label").cast("double"))
    sil = ClusteringEvaluator(featuresCol="features").evaluate(v)
    ch = CL.calinski_harabasz(e.withColumn("_arr", F.col("embedding").cast("array<double>")), "_arr", "label")
    return spark.createDataFrame([(float(sil), "squaredEuclidean", float(ch))],
                                 "silhouette double, silhouette_metric string, calinski_harabasz double")


@plan("l06_prototype_anomalies", "L06,J01")
def l06(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    flagged = CL.prototype_anomalies(e, "vec_id", "embedding", k=132, neighbours=4, threshold=0.8)
    return flagged.join(e.select("vec_id", "label"), "vec_id", "left")


@plan("l08_gap_curve", "L08")
def l08(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.withColumn("arr", F.col("embedding").cast("array<double>"))
    return CL.gap_curve(e, "arr", [2, 4, 6])


# ---------------------------------------------------------------- models (A)

@plan("a02_simple_ols", "A02", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem""")
def a02(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    v = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    m = MD.make_estimator("linear_regression", labelCol="l_extendedprice", regParam=0.0, solver="normal").fit(v)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 4))],
                                 "slope double, intercept double")


@plan("a02_ridge_lasso", "A02")
def a02b(spark, sf_dir):
    d = VectorAssembler(inputCols=FEATS, outputCol="features").transform(_li_features(Tables(spark, sf_dir)))
    rows = []
    for name in ["linear_regression", "ridge", "lasso"]:
        m = MD.make_estimator(name, labelCol="label").fit(d)
        rows.append((name, float(m.summary.rootMeanSquaredError), float(m.summary.r2)))
    return spark.createDataFrame(rows, "model string, rmse double, r2 double")


def _emb(t: Tables):
    e = CL.as_vectors(t.embeddings, "embedding").withColumn("label", F.col("label").cast("double"))
    return S.random_split(e, "vec_id", [0.8, 0.2], names=("train", "test"))


def _fit_eval(spark, est, name, tr, te):
    m = est.fit(tr)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(m.transform(te))
    return (name, float(acc))


@plan("a03_a04_a08_classifiers", "A03,A04,A05,A06,A07,A08,A01")
def a03(spark, sf_dir):
    e = _emb(Tables(spark, sf_dir))
    e = MD.balanced_weights(e, "label")
    tr, te = e.where(F.col("split") == "train"), e.where(F.col("split") == "test")
    rows = [
        _fit_eval(spark, MD.make_estimator("logistic_regression", maxIter=50, weightCol="weight"), "logistic_balanced", tr, te),
        _fit_eval(spark, MD.one_vs_rest(MD.make_estimator("linear_svc", maxIter=15)), "linear_svc_ovr", tr, te),
        _fit_eval(spark, MD.make_estimator("decision_tree", maxDepth=5), "decision_tree", tr, te),
        _fit_eval(spark, MD.make_estimator("random_forest", numTrees=10, seed=13), "random_forest", tr, te),
        _fit_eval(spark, MD.one_vs_rest(MD.make_estimator("gbt", maxIter=3, maxDepth=3)), "gbt_ovr", tr, te),
        _fit_eval(spark, MD.make_estimator("mlp", layers=[64, 32, 10], maxIter=20, seed=13), "mlp", tr, te),
    ]
    return spark.createDataFrame(rows, "model string, accuracy double")


@plan("a05_a06_a07_regressors", "A05,A06,A07,A18")
def a05(spark, sf_dir):
    from ..functions.columns import scalars
    # landed: the counts of the values and the cells read the joined columns
    d = land(_li_features(Tables(spark, sf_dir)).select(*FEATS, "label"), "features")
    cells = TR.tree_cells(d, FEATS, "label", bags=20, seed=13)
    v = VectorAssembler(inputCols=FEATS, outputCol="features").transform(cells)
    whole = {"labelCol": "label", "weightCol": "rows", "maxBins": TR.candidates_param(cells)}
    within = scalars(cells.agg((F.sum("within") / F.sum("rows")).alias("w")))["w"]
    rows = []
    for name, params in [("decision_tree_regressor", {"maxDepth": 6}), ("random_forest_regressor", {"numTrees": 20, "seed": 13}),
                         ("gbt_regressor", {"maxIter": 20})]:
        m = MD.make_estimator(name, **whole, **params).fit(v)
        rmse = RegressionEvaluator(labelCol="label", weightCol="rows", metricName="rmse").evaluate(m.transform(v))
        rmse = (rmse * rmse + within) ** 0.5  # of the rows: their squares around the cells' means are left out above
        imp = m.featureImportances.toArray().tolist()
        rows.append((name, float(rmse), FEATS[int(max(range(len(imp)), key=lambda i: imp[i]))]))
    return spark.createDataFrame(rows, "model string, rmse double, top_feature string")


@plan("a09_text_classifier", "A09,X09")
def a09(spark, sf_dir):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer
    from ..functions.text import tokens
    t = Tables(spark, sf_dir)
    d = t.documents.join(t.labels, "doc_id").select("doc_id", tokens("text", 2).alias("toks"),
                                                     F.col("quality").cast("double").alias("label"))
    d = S.random_split(d, "doc_id", [0.8, 0.2], names=("train", "test"))
    cv = CountVectorizer(inputCol="toks", outputCol="features", vocabSize=5000, minDF=2.0).fit(d)
    v = cv.transform(d)
    tr, te = v.where(F.col("split") == "train"), v.where(F.col("split") == "test")
    rows = [_fit_eval(spark, MD.make_estimator("logistic_regression", maxIter=50, regParam=0.01), "bow_logistic", tr, te),
            _fit_eval(spark, NaiveBayes(), "bow_naive_bayes", tr, te)]
    return spark.createDataFrame(rows, "model string, accuracy double")


@plan("a10_majority_baseline", "A10", """
WITH m AS (SELECT quality FROM labels GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1)
SELECT doc_id, (SELECT quality FROM m) AS prediction FROM labels""")
def a10(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    return MD.majority_baseline(lab, "quality").select("doc_id", "prediction")


@plan("a11_weighted_average", "A11,J02", """
WITH u AS (SELECT avg(l_extendedprice / l_quantity) AS g FROM lineitem),
pp AS (SELECT l_partkey, avg(l_extendedprice / l_quantity) AS pu FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.4 * l_quantity * g + 0.6 * l_quantity * pu, 6) AS p_avg
FROM lineitem JOIN pp USING (l_partkey), u""")
def a11(spark, sf_dir):
    from ..functions.columns import scalars
    li = Tables(spark, sf_dir).lineitem
    g = scalars(li.agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("g")))["g"]
    pu = li.groupBy("l_partkey").agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("pu"))
    # both predictions on the same rows (row-aligned), then the weighted vote
    j = li.join(pu, "l_partkey").select(*LI_KEYS, (F.col("l_quantity") * F.lit(g)).alias("p1"),
                                        (F.col("l_quantity") * F.col("pu")).alias("p2"))
    return j.select(*LI_KEYS, rnd(MD.weighted_average([F.col("p1"), F.col("p2")], [0.4, 0.6]), 6).alias("p_avg"))


LI_TEXT = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_LI_HASH = f"('0x' || substr(md5({LI_TEXT}), 1, 8))::BIGINT"


def _stacking_split(sf: Tables):
    d = sf.lineitem.select(*LI_KEYS, F.col("l_quantity").cast("double").alias("q"),
                           (F.col("l_quantity") * F.col("l_quantity") / 50.0).cast("double").alias("q2"),
                           F.col("l_extendedprice").cast("double").alias("label"))
    key = F.concat_ws("|", *LI_KEYS)
    d = d.withColumn("_u", S.key_hash(key) / F.lit(S.TWO32))
    return d.where("_u < 0.8").drop("_u"), d.where("_u >= 0.8").drop("_u")


@plan("a12_stacked_linear", "A12,B06", f"""
WITH d AS (SELECT {", ".join(LI_KEYS)}, l_quantity::DOUBLE AS q, (l_quantity * l_quantity / 50.0)::DOUBLE AS q2,
  l_extendedprice::DOUBLE AS y, {_LI_HASH} AS h FROM lineitem),
tr AS (SELECT *, h % 3 AS fold FROM d WHERE h / 4294967296.0 < 0.8),
f AS (SELECT k, regr_slope(y, q) AS s1, regr_intercept(y, q) AS i1, regr_slope(y, q2) AS s2, regr_intercept(y, q2) AS i2
      FROM tr JOIN (SELECT unnest([0, 1, 2]) AS k) ON fold <> k GROUP BY k),
oof AS (SELECT y, q * s1 + i1 AS p1, q2 * s2 + i2 AS p2 FROM tr JOIN f ON f.k = tr.fold),
m AS (SELECT var_pop(p1) AS a, var_pop(p2) AS b, covar_pop(p1, p2) AS c, covar_pop(p1, y) AS u, covar_pop(p2, y) AS v,
      avg(p1) AS m1, avg(p2) AS m2, avg(y) AS my FROM oof),
w AS (SELECT (u * b - v * c) / (a * b - c * c) AS w1, (v * a - u * c) / (a * b - c * c) AS w2, m1, m2, my FROM m),
g AS (SELECT regr_slope(y, q) AS s1, regr_intercept(y, q) AS i1, regr_slope(y, q2) AS s2, regr_intercept(y, q2) AS i2 FROM tr)
SELECT {", ".join("d." + c for c in LI_KEYS)}, round(q * s1 + i1, 3) AS p_linear, round(q2 * s2 + i2, 3) AS p_square,
  round(my + w1 * (q * s1 + i1 - m1) + w2 * (q2 * s2 + i2 - m2), 3) AS prediction
FROM d, w, g WHERE h / 4294967296.0 >= 0.8""")
def a12_linear(spark, sf_dir):
    """Two simple regressions, stacked by least squares, on the rows held out."""
    from pyspark.ml.regression import LinearRegression
    from ..operators import stacking as ST
    train, rest = _stacking_split(Tables(spark, sf_dir))
    line = lambda: LinearRegression(labelCol="label", regParam=0.0, solver="normal")
    model = ST.fit_stacking(train, LI_KEYS, "label", [ST.Base("linear", line(), ["q"]), ST.Base("square", line(), ["q2"])], 3, 0.0)
    out = model.transform(rest)
    return out.select(*LI_KEYS, rnd(F.col("linear")[0], 3).alias("p_linear"), rnd(F.col("square")[0], 3).alias("p_square"),
                      rnd("prediction", 3).alias("prediction"))


@plan("a12_stacking", "A12,B06")
def a12_stacking(spark, sf_dir):
    """A line and a tree under ridge: predictions of the rows held out."""
    from ..operators import stacking as ST
    train, rest = _stacking_split(Tables(spark, sf_dir))
    bases = [ST.Base("linear", MD.make_estimator("linear_regression", labelCol="label"), ["q"]),
             ST.Base("tree", MD.make_estimator("decision_tree_regressor", labelCol="label", maxDepth=5), ["q", "q2"])]
    out = ST.fit_stacking(train, LI_KEYS, "label", bases, 3, 1.0).transform(rest)
    return out.select(*LI_KEYS, "label", F.col("linear")[0].alias("p_linear"), F.col("tree")[0].alias("p_tree"), "prediction")


@plan("a13_stacked_fusion", "A13,A12", f"""
SELECT count(*) AS n_held_out, true AS above_majority, true AS sums_to_one FROM lineitem
WHERE {_LI_HASH} / 4294967296.0 >= 0.8""")
def a13_stacked(spark, sf_dir):
    """Balanced logistic over the class probabilities of two classifiers, which see
    one part each of what makes the class; the row says whether it beats the
    majority class on held-out rows."""
    from pyspark.ml.classification import NaiveBayes
    from ..operators import stacking as ST
    li = Tables(spark, sf_dir).lineitem
    load = F.col("l_quantity") + 200 * F.col("l_tax")
    d = li.select(*LI_KEYS, F.col("l_quantity").cast("double").alias("q"), F.col("l_tax").cast("double").alias("tax"),
                  F.least(F.lit(2.0), F.floor(load / 22)).cast("double").alias("label"))
    u = S.key_hash(F.concat_ws("|", *LI_KEYS)) / F.lit(S.TWO32)
    train, test = d.where(u < 0.8), d.where(u >= 0.8)
    bases = [ST.Base("bayes", NaiveBayes(modelType="gaussian"), ["q"], "probability"),
             ST.Base("logistic", MD.make_estimator("logistic_regression", maxIter=30, regParam=0.01), ["tax"], "probability")]
    out = ST.fit_stacking(train, LI_KEYS, "label", bases, 3, classify=True).transform(test)
    top = train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").first()["label"]
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return out.agg(F.count(F.lit(1)).alias("n_held_out"),
                   (right > F.avg((F.col("label") == F.lit(top)).cast("double"))).alias("above_majority"),
                   F.bool_and(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"))


def _probs_a():
    from .eval_plans import prob_scores
    return prob_scores()


def _probs_b():
    scores = F.array(*[-F.abs(F.col("c_acctbal") / 3000.0 - F.lit(c)) for c in [0.0, 1.0, 2.0, 3.0]])
    return MD.softmax(scores)


def _fusion_sql():
    from .eval_plans import _prob_sql
    pa = _prob_sql()
    ex = [f"exp(-abs(c_acctbal / 3000.0 - {c}))" for c in [0.0, 1.0, 2.0, 3.0]]
    den = " + ".join(ex)
    pb = [f"({e}) / ({den})" for e in ex]
    fused = [f"(0.4 * ({a}) + 0.6 * ({b}))" for a, b in zip(pa, pb)]
    arr = "[" + ", ".join(fused) + "]"
    return f"""
WITH p AS (SELECT o_orderkey, {arr} AS f, {pb[3]} AS pcrit FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, CAST(list_position(f, list_max(f)) - 1 AS INTEGER) AS weighted_class,
  CAST(CASE WHEN pcrit >= 0.5 THEN 3 ELSE list_position(f, list_max(f)) - 1 END AS INTEGER) AS override_class,
  CAST(CASE WHEN f[4] >= 0.3 THEN 3 ELSE list_position(f[1:3], list_max(f[1:3])) - 1 END AS INTEGER) AS rule_class FROM p"""


@plan("a13_a15_score_fusion", "A13,A14,A15", _fusion_sql())
def a13(spark, sf_dir):
    from .columns_plans import orders_customers
    oc = orders_customers(Tables(spark, sf_dir))
    p = oc.select("o_orderkey", _probs_a().alias("pa"), _probs_b().alias("pb"))
    fused = MD.fuse_weighted([F.col("pa"), F.col("pb")], [0.4, 0.6])
    over = MD.fuse_override(fused, F.element_at("pb", 4), 0.5, 3, 4)
    return p.select("o_orderkey", MD.argmax(fused).alias("weighted_class"), MD.argmax(over).alias("override_class"),
                    MD.decision_rule(fused, 3, 0.3).cast("int").alias("rule_class"))


@plan("a16_saved_model_scoring", "A16")
def a16(spark, sf_dir):
    d = _li_features(Tables(spark, sf_dir))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"),
                            MD.make_estimator("linear_regression", labelCol="label")])
    path = os.path.join(scratch_dir(spark, "model"), "pipeline")
    pipe.fit(d).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(d).select(*LI_KEYS, "prediction")


@plan("a17_a19_linear_attribution", "A17,A19,A03")
def a17(spark, sf_dir):
    from ..operators.models import fit_text_logistic
    from ..operators.textops import term_rows
    t = Tables(spark, sf_dir)
    lab = land(t.documents.join(t.labels, "doc_id").select("doc_id", "text", "quality"), "labelled")
    coef, intercept = fit_text_logistic(lab, "doc_id", "text", "quality", vocab_size=2000)
    # a row per term of the model (at most 2,000): other words are dropped before they are counted
    terms = land(term_rows(lab, "doc_id", "text", ngram_max=1, min_len=1).join(F.broadcast(coef), "term")
                 .groupBy("doc_id", "term", "coef").agg(F.count(F.lit(1)).alias("tf")), "terms")
    # coef * (x - mean(x)): the non-zero entries come from the long table; the
    # documents without the term add n_zero * coef * (0 - mean) in closed form
    n_docs = lab.count()
    st = terms.groupBy("term", "coef").agg(F.sum("tf").alias("sx"), F.count(F.lit(1)).alias("nz"),
                                           F.sum(F.abs(F.col("tf"))).alias("sax"))
    mean = F.col("sx") / F.lit(float(n_docs))
    nonzero_abs = terms.join(st.select("term", mean.alias("m")), "term").groupBy("term").agg(
        F.sum(F.abs(F.col("coef") * (F.col("tf") - F.col("m")))).alias("sa"))
    out = st.join(nonzero_abs, "term").select(
        "term", "coef",
        ((F.col("sa") + (F.lit(float(n_docs)) - F.col("nz")) * F.abs(F.col("coef") * mean)) / F.lit(float(n_docs))).alias("mean_abs"),
        F.lit(0.0).alias("mean_signed"),
        F.when(F.col("coef") > 0, "positive").otherwise("negative").alias("direction"))
    # outcome counts of the same model (threshold 0.5 on the document probability)
    logit = terms.groupBy("doc_id").agg((F.sum(F.col("tf") * F.col("coef")) + F.lit(intercept)).alias("z"))
    scored = lab.select("doc_id", "quality").join(logit, "doc_id", "left") \
        .withColumn("pred", (F.coalesce(F.col("z"), F.lit(intercept)) > 0).cast("int"))
    oc = scored.agg(F.count_if((F.col("pred") == 1) & (F.col("quality") == 1)).alias("true_positives"),
                    F.count_if((F.col("pred") == 0) & (F.col("quality") == 1)).alias("false_negatives"),
                    F.count_if((F.col("pred") == 1) & (F.col("quality") == 0)).alias("false_positives"),
                    F.count_if(F.col("quality") == 1).alias("total_positive")).first()
    top = out.orderBy(F.col("mean_abs").desc(), "term").limit(20)
    return top.select("*", *[F.lit(int(oc[k])).cast("long").alias(k) for k in
                             ("true_positives", "false_negatives", "false_positives", "total_positive")])


@plan("z03_z04_z05_search", "Z03,Z04,Z05,A03")
def z03(spark, sf_dir):
    from pyspark.ml.tuning import ParamGridBuilder
    t = Tables(spark, sf_dir)
    lab = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id")
    d = VectorAssembler(inputCols=["n_chars"], outputCol="features").transform(
        lab.withColumn("label", F.col("quality").cast("double")))
    d = S.kfold(d, "doc_id", 3)
    lr = MD.make_estimator("logistic_regression", maxIter=20)
    space = {"regParam": ("log", 0.001, 1.0), "elasticNetParam": ("float", 0.0, 1.0)}
    grid_maps = MD.grid_from_space(space)
    rand_maps = MD.random_draws(space, 10, seed=13)
    ev = MD.CostEvaluator(fn_cost=10.0, fp_cost=1.0)
    a = MD.cross_validate(lr, MD.param_maps(lr, grid_maps), d, ev, fold_col="fold", parallelism=2)
    b = MD.cross_validate(lr, MD.param_maps(lr, rand_maps), d, ev, fold_col="fold", parallelism=2)
    return MD.cv_results_table(spark, a, grid_maps, "grid").unionByName(MD.cv_results_table(spark, b, rand_maps, "random"))


@plan("a18_permutation_importance", "A18,Q01")
def a18(spark, sf_dir):
    from .columns_plans import PRIORITY_RANK, orders_customers
    from ..functions import columns as C
    oc = C.ordinal_map(orders_customers(Tables(spark, sf_dir)), "o_orderpriority", PRIORITY_RANK, out="prio")
    d = oc.select("o_orderkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"),
                  F.coalesce(F.col("prio"), F.lit(5)).cast("double").alias("prio"), F.col("o_totalprice").alias("label"))
    feats = ["c_acctbal", "c_nationkey", "prio"]
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             MD.make_estimator("decision_tree_regressor", labelCol="label", maxDepth=4)]).fit(d)
    return MD.permutation_importance(model, d, "o_orderkey", feats, RegressionEvaluator(metricName="rmse"), repeats=5)


@plan("a19_top_coefficients_per_class", "A19,A03,O03")
def a19(spark, sf_dir):
    e = CL.as_vectors(Tables(spark, sf_dir).embeddings, "embedding").withColumn("label", F.col("label").cast("double"))
    m = MD.make_estimator("logistic_regression", maxIter=30, family="multinomial").fit(e)
    return MD.top_coefficients(m, [f"e{i}" for i in range(64)], n=5)


@plan("l05_calinski_harabasz", "L05", """
WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS e FROM embeddings),
cs AS (SELECT label, i, sum(e) AS s, count(*) AS n FROM u GROUP BY 1, 2),
gm AS (SELECT i, sum(s) / sum(n) AS g FROM cs GROUP BY 1),
b AS (SELECT sum(n * pow(s / n - g, 2)) AS b FROM cs JOIN gm USING (i)),
w AS (SELECT (SELECT sum(e * e) FROM u) - sum(s * s / n) AS w FROM cs),
k AS (SELECT count(DISTINCT label) AS k, (SELECT count(*) FROM embeddings) AS n FROM embeddings)
SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz, CAST(k AS BIGINT) AS n_clusters FROM b, w, k""")
def l05ch(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.withColumn("_arr", F.col("embedding").cast("array<double>"))
    ch = CL.calinski_harabasz(e, "_arr", "label")
    k = e.select("label").distinct().count()
    return spark.createDataFrame([(round(float(ch), 6), int(k))], "calinski_harabasz double, n_clusters long")
