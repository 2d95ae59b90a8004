"""Plans for column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PR
from .registry import Tables, plan, rnd, round_all

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PCTS = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]


def _describe_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        qs = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {PR.pct_name(p)}" for p in PCTS)
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max,
  round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurt, {qs} FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@plan("g01_describe", "G01", _describe_sql("lineitem", LI_NUM))
def g01(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return round_all(PR.describe(li, LI_NUM, PCTS), 6)


def _labelled_docs(t: Tables):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


@plan("g02_missing_report", "G02", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (
  SELECT 'doc_id' AS "column", count_if(doc_id IS NULL) AS missing, count(*) AS n FROM j UNION ALL
  SELECT 'lang', count_if(lang IS NULL), count(*) FROM j UNION ALL
  SELECT 'quality', count_if(quality IS NULL), count(*) FROM j UNION ALL
  SELECT 'toxic', count_if(toxic IS NULL), count(*) FROM j)
SELECT "column", CAST(missing AS BIGINT) AS missing, round(missing / n, 9) AS share, missing / n > 0.05 AS over_threshold FROM m""")
def g02(spark, sf_dir):
    j = _labelled_docs(Tables(spark, sf_dir)).select("doc_id", "lang", "quality", "toxic")
    out = PR.missing_report(j, threshold=0.05)
    return out.select("column", "missing", rnd("share", 9).alias("share"), "over_threshold")


@plan("g03_value_counts", "G03", """
SELECT o_orderpriority AS value, count(*) AS count, round(count(*) / (SELECT count(o_orderpriority) FROM orders), 9) AS share
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def g03(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = PR.value_counts(o, "o_orderpriority")
    return out.select(F.col("o_orderpriority").alias("value"), "count", rnd("share", 9).alias("share"))


@plan("g03_value_counts_all_rows", "G03,M7", """
WITH j AS (SELECT l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT quality AS value, count(*) AS count, round(count(*) / (SELECT count(*) FROM j), 9) AS share
FROM j WHERE quality IS NOT NULL GROUP BY 1""")
def g03b(spark, sf_dir):
    j = _labelled_docs(Tables(spark, sf_dir))
    out = PR.value_counts(j, "quality", denominator="all")
    return out.select(F.col("quality").alias("value"), "count", rnd("share", 9).alias("share"))


def _iqr_sql(table, cols, k=1.5):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - {k} * (q3 - q1) AS lower,
  q3 + {k} * (q3 - q1) AS upper,
  (SELECT count(*) FROM {table} WHERE {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) AS n_outliers,
  (SELECT count({c}) FROM {table}) AS n
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})""")
    body = "\nUNION ALL\n".join(parts)
    return f"""SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower,
  round(upper, 6) AS upper, n_outliers, round(n_outliers / n, 9) AS share FROM ({body})"""


@plan("g04_iqr_outliers", "G04", _iqr_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def g04(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = PR.iqr_outliers(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return round_all(out, 6, skip=("share",)).withColumn("share", rnd("share", 9))


def _shape_case(skew, kurt):
    return (f"CASE WHEN abs({skew}) < 0.5 THEN 'symmetric' WHEN {skew} >= 1.0 THEN 'strong right skew' "
            f"WHEN {skew} > 0 THEN 'moderate right skew' WHEN {skew} <= -1.0 THEN 'strong left skew' "
            f"ELSE 'moderate left skew' END AS asymmetry, "
            f"CASE WHEN {kurt} > 1.0 THEN 'heavy tails' WHEN {kurt} < -1.0 THEN 'light tails' "
            f"ELSE 'normal tails' END AS tails")


@plan("g05_distribution_shape", "G05", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurt,
  {_shape_case(f'skewness({c})', f'kurtosis({c})')} FROM {t}"""
    for t, c in [("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount")]))
def g05(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = PR.distribution_shapes(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column", rnd("skew", 6).alias("skew"), rnd("kurt", 6).alias("kurt"), "asymmetry", "tails")


def _corr_sql(table, cols, src=None):
    src = src or table
    parts = []
    for i, a in enumerate(cols):
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS r")
            else:
                parts.append(f"SELECT '{a}', '{b}', round(corr({a}, {b}), 9) + 0.0 FROM {src}")
    return "\nUNION ALL\n".join(parts)


@plan("g06_pearson_matrix", "G06", _corr_sql("lineitem", LI_NUM))
def g06(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return PR.corr_matrix(li, LI_NUM).select("col_a", "col_b", rnd("r", 9).alias("r"))


SP_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _rank_expr(c):
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) AS {c}"


@plan("g07_spearman_matrix", "G07,Q01", _corr_sql(
    "r", SP_COLS, src="(SELECT " + ", ".join(_rank_expr(c) for c in SP_COLS) + " FROM lineitem)"))
def g07(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return PR.spearman_matrix(li, SP_COLS, "key").select("col_a", "col_b", rnd("r", 9).alias("r"))


@plan("g08_target_correlation", "G08", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 9) + 0.0 AS r, "
    f"round(abs(corr({c}, l_extendedprice)), 9) AS abs_r FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax"]))
def g08(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = PR.target_correlations(li, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return out.select("feature", rnd("r", 9).alias("r"), rnd("abs_r", 9).alias("abs_r"))


@plan("g29_histogram", "G29", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
w AS (SELECT lo, (hi - lo) / 10 AS w FROM s),
b AS (SELECT least(CAST(floor((o_totalprice - lo) / w) AS INTEGER), 9) AS bin FROM orders, w),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10))
SELECT g.bin, round(lo + g.bin * w, 6) AS lower, round(lo + (g.bin + 1) * w, 6) AS upper, coalesce(c.count, 0) AS count
FROM g LEFT JOIN c ON g.bin = c.bin, w""")
def g29(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return round_all(PR.histogram(o, "o_totalprice", 10), 6)


@plan("g30_kde_grid", "G30")
def g30(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return PR.kde_grid(o, "o_totalprice", grid_points=100)


@plan("g31_eda_summary", "G31", """
SELECT count(*) AS n_rows, count(l.doc_id) AS n_labelled, round(count(l.doc_id) / count(*), 9) AS labelled_share,
  round(avg(d.n_chars), 6) AS mean_chars, count(DISTINCT d.source) AS n_sources, count(DISTINCT d.lang) AS n_langs
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def g31(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "source", "lang", "n_chars") \
        .join(t.labels.select("doc_id", F.lit(1).alias("lab")), "doc_id", "left")
    out = PR.eda_summary(j, {
        "n_rows": F.count(F.lit(1)), "n_labelled": F.count("lab"),
        "labelled_share": F.count("lab") / F.count(F.lit(1)), "mean_chars": F.avg("n_chars"),
        "n_sources": F.count_distinct("source"), "n_langs": F.count_distinct("lang")})
    return out.select("n_rows", "n_labelled", rnd("labelled_share", 9).alias("labelled_share"),
                      rnd("mean_chars", 6).alias("mean_chars"), "n_sources", "n_langs")


@plan("g32_box_stats", "G32", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
             quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT o.o_orderpriority, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(o_totalprice) FILTER (WHERE o_totalprice >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(o_totalprice) FILTER (WHERE o_totalprice <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  CAST(count_if(o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers,
  count(*) AS n
FROM orders o JOIN q ON o.o_orderpriority = q.o_orderpriority GROUP BY ALL""")
def g32(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return round_all(PR.box_stats(o, "o_totalprice", ["o_orderpriority"]), 6)


@plan("g33_group_trend", "G33", """
SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
FROM lineitem GROUP BY 1 HAVING count(*) >= 10""")
def g33(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return round_all(PR.group_trend(li, "l_quantity", "l_extendedprice", ["l_returnflag"]), 6)


@plan("g34_geometric_mean", "G34", """
SELECT o_orderpriority, round(exp(avg(ln(o_totalprice))), 6) AS geo_mean FROM orders GROUP BY 1""")
def g34(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return round_all(PR.geometric_mean(o, "o_totalprice", ["o_orderpriority"]), 6)
