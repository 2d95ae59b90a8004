"""Plans for evaluation, cost and recovery tables (V02-V19) and the tabular
parts of model search (Z02, Z06-Z09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cost as CO
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import split as S
from .columns_plans import orders_customers
from .registry import Tables, plan, rnd, round_all
from .stats_plans import MODEL_SQL, MODELS, model_preds

TRUE_CASE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'critico' WHEN '2-HIGH' THEN 'alto' "
             "WHEN '3-MEDIUM' THEN 'medio' ELSE 'baixo' END")
PRED_CASE = ("CASE WHEN o_totalprice <= 100000 THEN 'baixo' WHEN o_totalprice <= 200000 THEN 'medio' "
             "WHEN o_totalprice <= 300000 THEN 'alto' ELSE 'critico' END")
PRED_B_CASE = ("CASE WHEN c_acctbal < 0 THEN 'baixo' WHEN c_acctbal < 3000 THEN 'medio' "
               "WHEN c_acctbal < 6000 THEN 'alto' ELSE 'critico' END")
CENTERS = [0.5, 1.5, 2.5, 3.5]


def true_class():
    return (F.when(F.col("o_orderpriority") == "1-URGENT", "critico").when(F.col("o_orderpriority") == "2-HIGH", "alto")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "medio").otherwise("baixo"))


def pred_class():
    x = F.col("o_totalprice")
    return (F.when(x <= 100000, "baixo").when(x <= 200000, "medio").when(x <= 300000, "alto").otherwise("critico"))


def pred_b_class():
    x = F.col("c_acctbal")
    return (F.when(x < 0, "baixo").when(x < 3000, "medio").when(x < 6000, "alto").otherwise("critico"))


def classified(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice", true_class().alias("true_class"), pred_class().alias("pred_class"))


def prob_scores():
    """Softmax of the scores ``-|o_totalprice/1e5 - centre_c|`` (class order)."""
    scores = F.array(*[-F.abs(F.col("o_totalprice") / 100000.0 - F.lit(c)) for c in CENTERS])
    return MD.softmax(scores)


def _prob_sql():
    ex = [f"exp(-abs(o_totalprice / 100000.0 - {c}))" for c in CENTERS]
    den = " + ".join(ex)
    return [f"({e}) / ({den})" for e in ex]


CLS = CO.CLASS_ORDER
ORD_CLS_SQL = f"(SELECT o_orderkey, o_totalprice, {TRUE_CASE} AS true_class, {PRED_CASE} AS pred_class FROM orders)"


@plan("v02_confusion_matrix", "V02", f"""
SELECT true_class, pred_class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY true_class), 9) AS rate
FROM {ORD_CLS_SQL} GROUP BY 1, 2""")
def v02(spark, sf_dir):
    c = classified(Tables(spark, sf_dir))
    return M.confusion_matrix(c, "true_class", "pred_class").withColumn("rate", rnd("rate", 9))


@plan("v03_classification_report", "V03,M21", f"""
WITH c AS {ORD_CLS_SQL},
s AS (SELECT true_class AS t, count(*) AS support, count_if(true_class = pred_class) AS tp FROM c GROUP BY 1),
p AS (SELECT pred_class AS t, count(*) AS n_pred FROM c GROUP BY 1),
per AS (SELECT s.t, support, tp, coalesce(n_pred, 0) AS n_pred,
          CASE WHEN coalesce(n_pred, 0) = 0 THEN 0.0 ELSE tp / n_pred END AS precision, tp / support AS recall
        FROM s LEFT JOIN p USING (t)),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
SELECT t AS label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f""")
def v03(spark, sf_dir):
    c = classified(Tables(spark, sf_dir))
    return round_all(M.classification_report(c, "true_class", "pred_class"), 9)


SCORE_SQL = "least(1.0::DOUBLE, d.n_chars::DOUBLE / 5000.0::DOUBLE)"
BIN_SQL = f"(SELECT l.quality AS y, {SCORE_SQL} AS score FROM labels l JOIN documents d USING (doc_id))"


def binary_scored(t: Tables):
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("score"))


def _thr_sql(extra=""):
    return f"""
WITH g AS (SELECT range::DOUBLE / 100.0 AS threshold FROM range(1, 100)),
c AS (SELECT threshold, CAST(count_if(y = 1 AND score > threshold) AS BIGINT) AS tp,
        CAST(count_if(y <> 1 AND score > threshold) AS BIGINT) AS fp,
        CAST(count_if(y = 1 AND NOT score > threshold) AS BIGINT) AS fn,
        CAST(count_if(y <> 1 AND NOT score > threshold) AS BIGINT) AS tn FROM g CROSS JOIN {BIN_SQL} GROUP BY threshold)"""


@plan("v04_threshold_table", "V04", _thr_sql() + """
SELECT threshold, tp, fp, fn, tn, round(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 9) AS precision,
  round(tp / (tp + fn), 9) AS recall, round(fp / (tp + fp + fn + tn), 9) AS fp_share, round(fn / (tp + fp + fn + tn), 9) AS fn_share
FROM c""")
def v04(spark, sf_dir):
    b = binary_scored(Tables(spark, sf_dir))
    return round_all(M.threshold_table(b, "y", "score"), 9, skip=("threshold",))


@plan("v05_roc_pr_auc", "V05,Q09", f"""
WITH d AS (SELECT score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM {BIN_SQL} GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM d),
t AS (SELECT sum(pos)::DOUBLE AS "P", sum(neg)::DOUBLE AS "NN" FROM d)
SELECT round(sum((neg / "NN") * (2.0 * tp - pos) / (2.0 * "P")), 9) AS roc_auc,
  round(sum((pos / "P") * (tp / (tp + fp))), 9) AS average_precision FROM c, t""")
def v05(spark, sf_dir):
    b = binary_scored(Tables(spark, sf_dir))
    return round_all(M.auc_scores(b, "y", "score"), 9)


@plan("v05_curve_points", "V05", f"""
WITH d AS (SELECT score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM {BIN_SQL} GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM d),
t AS (SELECT sum(pos)::DOUBLE AS "P", sum(neg)::DOUBLE AS "NN" FROM d)
SELECT round(score, 9) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / "P", 9) AS tpr, round(fp / "NN", 9) AS fpr,
  round(tp / (tp + fp), 9) AS "precision" FROM c, t""")
def v05_points(spark, sf_dir):
    """ROC and precision-recall points at every distinct score."""
    pts = M.roc_points(binary_scored(Tables(spark, sf_dir)), "y", "score")
    return round_all(pts.select("score", "tp", "fp", "tpr", "fpr", "precision"), 9)


def _model_metric_long(m):
    out = None
    for mod in MODELS:
        r = F.col(mod) == F.col("quality")
        agg = m.agg(
            (F.count_if(r) / F.count(F.lit(1))).alias("accuracy"),
            F.try_divide(F.count_if((F.col(mod) == 1) & (F.col("quality") == 1)), F.count_if(F.col(mod) == 1)).alias("precision"),
            F.try_divide(F.count_if((F.col(mod) == 1) & (F.col("quality") == 1)), F.count_if(F.col("quality") == 1)).alias("recall"),
            F.lit(None).cast("double").alias("auc"))
        st = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
                                 for k in ("accuracy", "precision", "recall", "auc")])).alias("s")
        part = agg.select(F.lit(mod).alias("model"), st).select("model", "s.*")
        out = part if out is None else out.unionByName(part)
    return out


@plan("v06_model_comparison", "V06", " UNION ALL ".join(
    f"""SELECT '{m}' AS model, round(count_if({m} = quality) / count(*), 9) AS accuracy,
  round(count_if({m} = 1 AND quality = 1) / nullif(count_if({m} = 1), 0), 9) AS precision,
  round(count_if({m} = 1 AND quality = 1) / nullif(count_if(quality = 1), 0), 9) AS recall FROM {MODEL_SQL}"""
    for m in MODELS))
def v06(spark, sf_dir):
    long = _model_metric_long(model_preds(Tables(spark, sf_dir)))
    return round_all(M.comparison_table(long, "model", "metric", "value"), 9)


@plan("v07_profit_by_threshold", "V07", _thr_sql() + """
SELECT threshold, round((50.0 * tp - 5.0 * fn - 5.0 * tn - 150.0 * fp) / (tp + fp + fn + tn), 9) AS avg_profit FROM c""")
def v07(spark, sf_dir):
    b = binary_scored(Tables(spark, sf_dir))
    t = M.threshold_table(b, "y", "score")
    return t.select("threshold", rnd(MD.profit_per_row(F.col("tp"), F.col("fn"), F.col("tn"), F.col("fp")), 9).alias("avg_profit"))


def _rates_sql(src):
    return f"(SELECT true_class, pred_class, count(*) / sum(count(*)) OVER (PARTITION BY true_class) AS rate FROM {src} GROUP BY 1, 2)"


def _cost_values_sql():
    rows = []
    for t in CLS:
        for j, p in enumerate(CLS):
            rows.append(f"('{t}', '{p}', {float(CO.COST_MATRIX[t][j])}::DOUBLE, {CO.CLASS_PRIORS[t]}::DOUBLE)")
    return "(VALUES " + ", ".join(rows) + ") AS k(true_class, pred_class, unit_cost, prior)"


BREAKDOWN_SQL = f"""(SELECT r.true_class, r.pred_class, rate, unit_cost, {CO.ANNUAL_RECORDS} * prior * rate AS coef,
  {CO.ANNUAL_RECORDS} * prior * rate * unit_cost AS cost
  FROM {_rates_sql(ORD_CLS_SQL)} r JOIN {_cost_values_sql()} USING (true_class, pred_class) WHERE r.true_class <> r.pred_class)"""


def _breakdown(spark, t):
    rates = M.confusion_matrix(classified(t), "true_class", "pred_class")
    return CO.expected_cost_breakdown(rates, spark)


@plan("v08_expected_annual_cost", "V08", f"SELECT round(sum(cost), 2) AS eace FROM {BREAKDOWN_SQL}")
def v08(spark, sf_dir):
    return CO.expected_annual_cost(_breakdown(spark, Tables(spark, sf_dir))).select(rnd("eace", 2).alias("eace"))


@plan("v09_cost_breakdown", "V09", f"""
SELECT true_class, pred_class, round(rate, 9) AS rate, unit_cost, round(coef, 6) AS coef, round(cost, 2) AS cost FROM {BREAKDOWN_SQL}""")
def v09(spark, sf_dir):
    b = _breakdown(spark, Tables(spark, sf_dir))
    return b.select("true_class", "pred_class", rnd("rate", 9).alias("rate"), "unit_cost", rnd("coef", 6).alias("coef"),
                    rnd("cost", 2).alias("cost"))


def _cee_sql():
    ps = _prob_sql()
    probs = "[" + ", ".join(ps) + "]"
    rows = "[" + ", ".join("[" + ", ".join(f"{float(v)}" for v in CO.COST_MATRIX[c]) + "]" for c in CLS) + "]"
    return f"""(WITH p AS (SELECT o_orderkey, {probs} AS p FROM orders),
q AS (SELECT o_orderkey, p, list_position(p, list_max(p)) AS k FROM p)
SELECT o_orderkey, CAST(k - 1 AS INTEGER) AS pred,
  list_sum(list_transform(range(1, 5), lambda i: p[i] * ({rows})[k][i])) AS cee FROM q)"""


def _cee_df(t: Tables):
    o = t.orders.select("o_orderkey", "o_totalprice").withColumn("p", prob_scores())
    pred, cee = CO.expected_cost_per_record(F.col("p"))
    return o.select("o_orderkey", pred.alias("pred"), cee.alias("cee"))


CLS_ARR = "['" + "', '".join(CLS) + "']"


@plan("v10_v11_expected_cost_recovery", "V10,V11,A14,M18", f"""
SELECT o_orderkey, pred, round(cee, 6) AS cee, CASE WHEN cee <= 50000 THEN {CLS_ARR}[pred + 1] END AS label FROM {_cee_sql()}""")
def v10(spark, sf_dir):
    c = _cee_df(Tables(spark, sf_dir))
    return c.select("o_orderkey", "pred", rnd("cee", 6).alias("cee"),
                    CO.recover_label(F.col("pred"), F.col("cee"), 50000).alias("label"))


@plan("v12_recovery_metrics", "V12", f"""
WITH c AS (SELECT *, CASE WHEN cee <= 50000 THEN {CLS_ARR}[pred + 1] END AS label FROM {_cee_sql()})
SELECT count(*) AS n_total, CAST(count_if(label IS NOT NULL) AS BIGINT) AS n_recovered,
  CAST(count_if(label IS NULL) AS BIGINT) AS n_abstain, """ + ", ".join(
    f"CAST(count_if(label = '{c}') AS BIGINT) AS n_{c}" for c in CLS) + """,
  round(avg(cee) FILTER (WHERE label IS NOT NULL), 4) AS cee_recovered_mean,
  round(max(cee) FILTER (WHERE label IS NOT NULL), 4) AS cee_recovered_max,
  round(avg(cee) FILTER (WHERE label IS NULL), 4) AS cee_abstained_mean,
  round(min(cee) FILTER (WHERE label IS NULL), 4) AS cee_abstained_min,
  round(median(cee) FILTER (WHERE label IS NOT NULL), 4) AS cee_recovered_median,
  round(count_if(label IS NOT NULL) / count(*) * 100, 9) AS recovery_rate_pct FROM c""")
def v12(spark, sf_dir):
    c = _cee_df(Tables(spark, sf_dir))
    c = c.withColumn("label", CO.recover_label(F.col("pred"), F.col("cee"), 50000))
    out = CO.recovery_metrics(c, "label", "cee")
    return round_all(out, 4, skip=("recovery_rate_pct",)).withColumn("recovery_rate_pct", rnd("recovery_rate_pct", 9))


LIMITS = [10000.0 * i for i in range(1, 11)]


@plan("v13_recovery_by_limit", "V13", " UNION ALL ".join(
    f"SELECT {x}::DOUBLE AS limit, CAST(count_if(cee <= {x}) AS BIGINT) AS n_recovered, "
    f"round(count_if(cee <= {x}) / count(*) * 100, 9) AS recovery_rate_pct FROM {_cee_sql()}" for x in LIMITS))
def v13(spark, sf_dir):
    c = _cee_df(Tables(spark, sf_dir))
    return CO.recovery_by_limit(c, "cee", LIMITS).withColumn("recovery_rate_pct", rnd("recovery_rate_pct", 9))


OCB_SQL = f"""(SELECT 'price' AS model, {TRUE_CASE} AS true_class, {PRED_CASE} AS pred_class FROM orders
  UNION ALL SELECT 'balance', {TRUE_CASE}, {PRED_B_CASE} FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""
COEF_SQL = f"""(SELECT model, r.true_class, r.pred_class, {CO.ANNUAL_RECORDS} * prior * rate AS coef, unit_cost
  FROM (SELECT model, true_class, pred_class, count(*) / sum(count(*)) OVER (PARTITION BY model, true_class) AS rate
        FROM {OCB_SQL} GROUP BY 1, 2, 3) r JOIN {_cost_values_sql()} USING (true_class, pred_class)
  WHERE r.true_class <> r.pred_class)"""


def _two_models(t: Tables):
    oc = orders_customers(t)
    a = t.orders.select(F.lit("price").alias("model"), true_class().alias("true_class"), pred_class().alias("pred_class"))
    b = oc.select(F.lit("balance").alias("model"), true_class().alias("true_class"), pred_b_class().alias("pred_class"))
    return a.unionByName(b)


def _coef_df(spark, t):
    rates = M.confusion_matrix(_two_models(t), "true_class", "pred_class", group_cols=["model"])
    return CO.expected_cost_breakdown(rates, spark, model_cols=["model"])


@plan("v14_cost_coefficients", "V14", f"SELECT model, true_class, pred_class, round(coef, 6) AS coef FROM {COEF_SQL}")
def v14(spark, sf_dir):
    c = _coef_df(spark, Tables(spark, sf_dir))
    return c.select("model", "true_class", "pred_class", rnd("coef", 6).alias("coef"))


GRID = [400000.0 * i for i in range(17)]


@plan("v15_break_even", "V15,J07", f"""
WITH t AS (SELECT model, sum(CASE WHEN true_class = 'critico' AND pred_class = 'baixo' THEN 0 ELSE coef * unit_cost END) AS base,
             sum(CASE WHEN true_class = 'critico' AND pred_class = 'baixo' THEN coef ELSE 0 END) AS cf FROM {COEF_SQL} GROUP BY 1),
g AS (SELECT model, x, base + cf * x AS total FROM t CROSS JOIN (SELECT unnest([{', '.join(str(v) for v in GRID)}]) AS x)),
d AS (SELECT *, lead(total) OVER (PARTITION BY x ORDER BY model) - total AS diff FROM g)
SELECT model, x, round(total, 2) AS total, round(diff, 2) AS diff_to_next,
  sign(diff) <> lag(sign(diff)) OVER (PARTITION BY model ORDER BY x) AS crossing FROM d""")
def v15(spark, sf_dir):
    c = _coef_df(spark, Tables(spark, sf_dir))
    is_cell = (F.col("true_class") == "critico") & (F.col("pred_class") == "baixo")
    tot = c.groupBy("model").agg(F.sum(F.when(is_cell, 0.0).otherwise(F.col("coef") * F.col("unit_cost"))).alias("base"),
                                 F.sum(F.when(is_cell, F.col("coef")).otherwise(0.0)).alias("cf"))
    out = CO.break_even(tot, "model", "base", "cf", GRID)
    return out.select("model", "x", rnd("total", 2).alias("total"), rnd("diff_to_next", 2).alias("diff_to_next"), "crossing")


@plan("v16_cost_uncertainty", "V16", f"""
WITH v AS (SELECT {TRUE_CASE} AS true_class, {PRED_CASE} AS pred_class, var_samp(o_totalprice) AS var_cost, count(*) AS n_obs
           FROM orders GROUP BY 1, 2),
j AS (SELECT model, c.true_class, c.pred_class, coef, var_cost, n_obs, coef * coef * var_cost AS var_contrib,
        coef * sqrt(var_cost) AS sigma_effect FROM {COEF_SQL} c JOIN v USING (true_class, pred_class))
SELECT model, true_class, pred_class, n_obs, round(coef, 6) AS coef, round(sigma_effect, 2) AS sigma_effect,
  round(var_contrib / sum(var_contrib) OVER (PARTITION BY model), 9) AS var_share FROM j""")
def v16(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cells = _coef_df(spark, t)
    recs = classified(t)
    out = CO.cost_uncertainty(cells, recs, ["true_class", "pred_class"], "o_totalprice", ["model"])
    return out.select("model", "true_class", "pred_class", "n_obs", rnd("coef", 6).alias("coef"),
                      rnd("sigma_effect", 2).alias("sigma_effect"), rnd("var_share", 9).alias("var_share"))


@plan("v17_bootstrap_interval", "V17")
def v17(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return CO.bootstrap_mean(o, "o_totalprice", "o_orderkey", replicates=200)


def _unit_price_sql():
    return "(SELECT avg(l_extendedprice / l_quantity) AS u FROM lineitem)"


@plan("v18_residual_table", "V18,G29", f"""
WITH r AS (SELECT l_extendedprice - l_quantity * u AS e FROM lineitem, {_unit_price_sql()}),
s AS (SELECT min(e) AS lo, max(e) AS hi, count(*) AS n FROM r),
w AS (SELECT lo, (hi - lo) / 20 AS w, n FROM s),
b AS (SELECT least(CAST(floor((e - lo) / w) AS INTEGER), 19) AS bin FROM r, w),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20)),
h AS (SELECT g.bin, coalesce(c.count, 0) AS count FROM g LEFT JOIN c ON g.bin = c.bin)
SELECT bin, round(lo + bin * w, 4) AS lower, round(lo + (bin + 1) * w, 4) AS upper, count,
  round(sum(count) OVER (ORDER BY bin) / n, 9) AS cum_share FROM h, w""")
def v18(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    from .order_plans import _unit_price
    u = _unit_price(li)
    res = li.select((F.col("l_extendedprice") - F.col("l_quantity") * F.lit(u)).alias("e"))
    out = MD.residual_histogram(res, "e", 20)
    return out.select("bin", rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"), "count",
                      rnd("cum_share", 9).alias("cum_share"))


def _v19_sql():
    from .registry import SQL
    return f"""
SELECT feature, 'categorical' AS type, encoder AS transformer, strength AS reason,
  CASE strength WHEN 'strong' THEN 1 WHEN 'moderate' THEN 2 ELSE 3 END AS priority FROM ({SQL['h10_feature_signal']}) s
UNION ALL SELECT 'text', 'text', 'tfidf', 'free text', 1
UNION ALL SELECT 'o_orderdate', 'datetime', 'cyclic hour/month', 'seasonality', 2"""


@plan("v19_pipeline_spec", "V19,H10", _v19_sql())
def v19(spark, sf_dir):
    from .stats_plans import h10
    sig = h10(spark, sf_dir)
    return MD.pipeline_spec(sig)


# ---------------------------------------------------------------- search tables (Z)

LI_KEY_SQL = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate))"
FOLD_SQL = f"CAST((('0x' || substr({LI_KEY_SQL}, 1, 8))::BIGINT) % 5 AS INTEGER)"


def li_folds(t: Tables):
    li = t.lineitem
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("string"))
    return li.withColumn("fold", F.pmod(S.key_hash(key), F.lit(5)).cast("int"))


FOLD_METRICS_SQL = f"""(WITH f AS (SELECT *, {FOLD_SQL} AS fold, l_extendedprice / l_quantity AS up FROM lineitem),
a AS (SELECT sum(up) AS s, count(*) AS c FROM f),
fs AS (SELECT fold, sum(up) AS s, count(*) AS c FROM f GROUP BY fold),
p AS (SELECT f.fold, l_extendedprice AS y, l_quantity * (a.s - fs.s) / (a.c - fs.c) AS p FROM f JOIN fs USING (fold), a)
SELECT fold, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, avg(abs((y - p) / y)) * 100 AS mape FROM p GROUP BY fold)"""


@plan("z01_fold_metrics", "Z01,B06,V01", f"""
SELECT fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 9) AS r2, round(mape, 6) AS mape FROM {FOLD_METRICS_SQL}""")
def z01(spark, sf_dir):
    f = MD.kfold_unit_price_metrics(li_folds(Tables(spark, sf_dir)))
    return f.select("fold", rnd("rmse", 6).alias("rmse"), rnd("mae", 6).alias("mae"), rnd("r2", 9).alias("r2"),
                    rnd("mape", 6).alias("mape"))


@plan("z02_fold_summary", "Z02,M22", " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std,
  round(stddev_samp({m}) / avg({m}), 9) AS cv, round(avg({m}) - 1.96 * stddev_pop({m}) / sqrt(count(*)), 6) AS ci_low,
  round(avg({m}) + 1.96 * stddev_pop({m}) / sqrt(count(*)), 6) AS ci_high FROM {FOLD_METRICS_SQL}"""
    for m in ["rmse", "mae", "mape"]))
def z02(spark, sf_dir):
    f = MD.kfold_unit_price_metrics(li_folds(Tables(spark, sf_dir)))
    out = MD.fold_summary(f, ["rmse", "mae", "mape"])
    return out.select("metric", rnd("mean", 6).alias("mean"), rnd("std", 6).alias("std"), rnd("cv", 9).alias("cv"),
                      rnd("ci_low", 6).alias("ci_low"), rnd("ci_high", 6).alias("ci_high"))


@plan("z06_keep_if_better", "Z06", f"""
WITH f AS (SELECT *, {FOLD_SQL} AS fold, l_extendedprice / l_quantity AS up FROM lineitem),
a AS (SELECT sum(up) AS s, count(*) AS c FROM f),
fs AS (SELECT fold, sum(up) AS s, count(*) AS c FROM f GROUP BY fold),
ps AS (SELECT l_partkey, sum(up) AS s, count(*) AS c FROM f GROUP BY 1),
pfs AS (SELECT l_partkey, fold, sum(up) AS s, count(*) AS c FROM f GROUP BY 1, 2),
p AS (SELECT f.fold, l_extendedprice AS y, l_quantity * (a.s - fs.s) / (a.c - fs.c) AS p_base,
        l_quantity * CASE WHEN ps.c - pfs.c > 0 THEN (ps.s - pfs.s) / (ps.c - pfs.c) ELSE (a.s - fs.s) / (a.c - fs.c) END AS p_part
      FROM f JOIN fs USING (fold) JOIN ps USING (l_partkey) JOIN pfs ON pfs.l_partkey = f.l_partkey AND pfs.fold = f.fold, a),
m AS (SELECT 'baseline' AS model, avg(r) AS cv_rmse FROM (SELECT fold, sqrt(avg((y - p_base) * (y - p_base))) AS r FROM p GROUP BY 1)
      UNION ALL SELECT 'per_part', avg(r) FROM (SELECT fold, sqrt(avg((y - p_part) * (y - p_part))) AS r FROM p GROUP BY 1)),
k AS (SELECT *, model = 'baseline' OR cv_rmse < (SELECT cv_rmse FROM m WHERE model = 'baseline') AS kept FROM m)
SELECT model, round(cv_rmse, 6) AS cv_rmse, kept,
  CAST(rank() OVER (ORDER BY CASE WHEN kept THEN cv_rmse END ASC NULLS LAST) AS INTEGER) AS rank,
  model = (SELECT arg_min(model, cv_rmse) FROM k WHERE kept) AS best FROM k""")
def z06(spark, sf_dir):
    f = li_folds(Tables(spark, sf_dir))
    res = MD.candidate_cv(f)
    out = MD.keep_if_better(res, "model", "cv_rmse", baseline="baseline")
    return out.select("model", rnd("cv_rmse", 6).alias("cv_rmse"), "kept", "rank", "best")


COSTS_BIN = {"fn": 10.0, "fp": 1.0}


@plan("z07_selection_report", "Z07,H14", " UNION ALL ".join(
    f"""SELECT '{m}' AS model, CAST(count_if({m} = 0 AND quality = 1) AS BIGINT) * 10.0 + CAST(count_if({m} = 1 AND quality = 0) AS BIGINT) * 1.0 AS cost,
  round(count_if({m} = 1 AND quality = 1) / count_if(quality = 1), 9) AS recall FROM {MODEL_SQL}""" for m in MODELS)
    .join(["WITH r AS (", ")"]) + """
SELECT model, cost, recall, cost = min(cost) OVER () AS best_by_cost, recall = max(recall) OVER () AS best_by_recall,
  (SELECT arg_min(model, cost) FROM r) = (SELECT arg_max(model, recall) FROM r) AS same_winner FROM r""")
def z07(spark, sf_dir):
    m = model_preds(Tables(spark, sf_dir))
    out = MD.selection_report(m, "quality", MODELS, fn_cost=10.0, fp_cost=1.0)
    return out.select("model", "cost", rnd("recall", 9).alias("recall"), "best_by_cost", "best_by_recall", "same_winner")


@plan("z08_robustness_label", "Z08,B01", f"""
WITH cv AS (SELECT avg(rmse) AS cv_rmse FROM {FOLD_METRICS_SQL}),
s AS (SELECT *, CASE WHEN ('0x' || substr({LI_KEY_SQL}, 1, 8))::BIGINT / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS split,
        l_extendedprice / l_quantity AS up FROM lineitem),
u AS (SELECT avg(up) AS u FROM s WHERE split = 'train'),
h AS (SELECT sqrt(avg(pow(l_extendedprice - l_quantity * u, 2))) AS holdout_rmse FROM s, u WHERE split = 'test')
SELECT round(cv_rmse, 6) AS cv_rmse, round(holdout_rmse, 6) AS holdout_rmse, round(abs(holdout_rmse - cv_rmse) / cv_rmse, 9) AS gap,
  CASE WHEN abs(holdout_rmse - cv_rmse) / cv_rmse < 0.10 THEN 'robust' WHEN abs(holdout_rmse - cv_rmse) / cv_rmse < 0.20
       THEN 'moderate' ELSE 'overfit risk' END AS robustness FROM cv, h""")
def z08(spark, sf_dir):
    t = Tables(spark, sf_dir)
    f = li_folds(t)
    cv = MD.kfold_unit_price_metrics(f).agg(F.avg("rmse").alias("cv_rmse"))
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("string"))
    s = t.lineitem.withColumn("split", F.when(S.key_uniform(key) < 0.8, "train").otherwise("test"))
    hold = MD.holdout_unit_price_rmse(s)
    out = MD.robustness(cv.first()["cv_rmse"], hold, spark)
    return out.select(rnd("cv_rmse", 6).alias("cv_rmse"), rnd("holdout_rmse", 6).alias("holdout_rmse"),
                      rnd("gap", 9).alias("gap"), "robustness")


@plan("z09_threshold_tuning", "Z09,V04", _thr_sql() + """,
m AS (SELECT threshold, CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END AS precision, tp / (tp + fn) AS recall FROM c)
SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM m WHERE precision >= 0.85
ORDER BY recall DESC, threshold LIMIT 1""")
def z09(spark, sf_dir):
    b = binary_scored(Tables(spark, sf_dir))
    t = M.threshold_table(b, "y", "score")
    best = MD.tune_threshold(t, precision_floor=0.85)
    return best.select("threshold", rnd("precision", 9).alias("precision"), rnd("recall", 9).alias("recall"))
