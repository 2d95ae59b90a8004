"""Plans for hypothesis tests."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import dist as DI
from ..operators import hypothesis as H
from .columns_plans import orders_customers
from .registry import Tables, plan, rnd

OC_SQL = "(SELECT o.*, c.c_mktsegment, c.c_acctbal, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"


def _k2_sql(table: str, x: str) -> str:
    return f"""
WITH b AS (SELECT {x} AS x FROM {table}),
m AS (SELECT count(*)::DOUBLE AS n, avg(x) AS mu FROM b),
c AS (SELECT any_value(n) AS n, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4 FROM b, m),
g AS (SELECT n, m3 / pow(m2, 1.5) AS b1, m4 / (m2 * m2) AS b2 FROM c),
s1 AS (SELECT *, b1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y0,
         3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
         3.0 * (n - 1) / (n + 1) AS e, 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS varb2,
         6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1
       FROM g),
s2 AS (SELECT *, -1.0 + sqrt(2.0 * (beta2 - 1)) AS w2, (b2 - e) / sqrt(varb2) AS xk,
         6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1.0 + 4.0 / (sb1 * sb1))) AS a FROM s1),
s3 AS (SELECT *, 1.0 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha,
         CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS y, 1.0 + xk * sqrt(2.0 / (a - 4)) AS den FROM s2),
s4 AS (SELECT n, delta * ln(y / alpha + sqrt(pow(y / alpha, 2) + 1)) AS zs,
         ((1.0 - 2.0 / (9.0 * a)) - sign(den) * pow((1.0 - 2.0 / a) / abs(den), 1.0 / 3.0)) / sqrt(2.0 / (9.0 * a)) AS zk
       FROM s3)
SELECT CAST(n AS BIGINT) AS n, round(zs, 6) AS z_skew, round(zk, 6) AS z_kurt, round(zs * zs + zk * zk, 6) AS k2,
  round(exp(-(zs * zs + zk * zk) / 2), 9) AS p_value FROM s4"""


@plan("h01_dagostino_k2", "H01", _k2_sql("orders", "o_totalprice"))
def h01(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = H.dagostino_k2(o, "o_totalprice")
    return out.select("n", rnd("z_skew", 6).alias("z_skew"), rnd("z_kurt", 6).alias("z_kurt"),
                      rnd("k2", 6).alias("k2"), rnd("p_value", 9).alias("p_value"))


@plan("h02_anderson_darling", "H02,Q01", f"""
WITH b AS (SELECT o_totalprice AS x, o_orderkey FROM orders),
s AS (SELECT count(*)::DOUBLE AS n, avg(x) AS m, stddev_samp(x) AS sd FROM b),
p AS (SELECT x, row_number() OVER (ORDER BY x, o_orderkey) AS i FROM b),
z AS (SELECT i, n, (x - m) / sd AS z FROM p, s),
t AS (SELECT any_value(n) AS n, sum((2.0 * i - 1) * ({DI.norm_logcdf_sql('z')})
        + (2.0 * (n + 1 - i) - 1) * ({DI.norm_logcdf_sql('-z')})) AS s FROM z)
SELECT CAST(n AS BIGINT) AS n, round(-n - s / n, 6) AS a2, round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 9) AS critical_5pct,
  (-n - s / n) > 0.787 / (1 + 4.0 / n - 25.0 / (n * n)) AS reject_5pct FROM t""")
def h02(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = H.anderson_darling(o, "o_totalprice", ["o_orderkey"])
    return out.select("n", rnd("a2", 6).alias("a2"), rnd("critical_5pct", 9).alias("critical_5pct"), "reject_5pct")


def _anova_sql(src: str) -> str:
    return f"""
WITH g AS ({src}),
t AS (SELECT sum(n) AS tot_n, sum(n * mean) / sum(n) AS gm, count(*) AS k FROM g),
s AS (SELECT sum(n * pow(mean - gm, 2)) AS ssb, sum((n - 1) * coalesce(var, 0)) AS ssw, any_value(tot_n) AS tot_n, any_value(k) AS k
      FROM g, t)"""


def _sig(p: str) -> str:
    return f"CASE WHEN {p} < 0.05 THEN 'significant' ELSE 'not significant' END"


def f4_sf_sql(f: str, d2: str) -> str:
    """Tail of F with 4 and d2 degrees (closed for an even first number)."""
    x = f"({d2}) / (({d2}) + 4.0 * ({f}))"
    return f"(pow({x}, ({d2}) / 2.0) * (1 + ({d2}) / 2.0 * (1 - {x})))"


def chi2_even_sf_sql(x: str, df: int) -> str:
    """Tail of chi-squared with an even number of degrees: a Poisson sum."""
    terms = " + ".join(f"pow(({x}) / 2.0, {i}) / {math.factorial(i)}.0" for i in range(df // 2))
    return f"(exp(-({x}) / 2.0) * ({terms}))"


def t_two_sided_sql(t: str, nu: str) -> str:
    """Two-sided tail of Student's t: the finite sums for even and odd degrees."""
    cos2, sin = f"(({nu}) / (({nu}) + ({t}) * ({t})))", f"sqrt(({t}) * ({t}) / (({nu}) + ({t}) * ({t})))"
    even = (f"{sin} * list_sum(list_transform(range(0, ({nu}) // 2), lambda j: "
            f"exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1.0) + j * ln({cos2}))))")
    odd = (f"2 / pi() * (asin({sin}) + {sin} * coalesce(list_sum(list_transform(range(0, (({nu}) - 1) // 2), lambda j: "
           f"exp(0.5 * ln(pi()) - ln(2) + lgamma(j + 1.0) - lgamma(j + 1.5) + (j + 0.5) * ln({cos2})))), 0))")
    return f"(1 - CASE WHEN ({nu}) % 2 = 0 THEN {even} ELSE {odd} END)"


_F = "(ssb / (k - 1)) / (ssw / (tot_n - k))"
H03_SRC = "SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, var_samp(o_totalprice) AS var FROM orders GROUP BY 1"


@plan("h03_anova_eta2", "H03,H13", _anova_sql(H03_SRC) + """
SELECT CAST(k - 1 AS BIGINT) AS df_between, CAST(tot_n - k AS BIGINT) AS df_within,
  round((ssb / (k - 1)) / (ssw / (tot_n - k)), 9) AS f, round(ssb / (ssb + ssw), 12) AS eta2,
  CASE WHEN ssb / (ssb + ssw) < 0.01 THEN 'negligible' WHEN ssb / (ssb + ssw) < 0.06 THEN 'small'
       WHEN ssb / (ssb + ssw) < 0.14 THEN 'medium' ELSE 'large' END AS eta2_magnitude,
  round(p, 6) AS p_value, """ + _sig("p") + " AS significance FROM (SELECT *, " + f4_sf_sql(_F, "tot_n - k") + " AS p FROM s)")
def h03(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = H.anova_oneway(o, "o_totalprice", "o_orderpriority")
    return a.select("df_between", "df_within", rnd("f", 9).alias("f"), rnd("eta2", 12).alias("eta2"),
                    H.eta2_magnitude(F.col("eta2")).alias("eta2_magnitude"), rnd("p_value", 6).alias("p_value"), "significance")


@plan("h04_kruskal_wallis", "H04,Q01", """
WITH r AS (SELECT l_returnflag AS g, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rk
           FROM lineitem),
t AS (SELECT count(*)::DOUBLE AS tot_n FROM lineitem),
ties AS (SELECT sum(pow(c, 3) - c) AS "T" FROM (SELECT count(*)::DOUBLE AS c FROM lineitem GROUP BY l_quantity)),
rs AS (SELECT g, count(*) AS n_g, sum(rk) AS r_g FROM r GROUP BY g)
SELECT df, round(h, 6) AS h, round(""" + chi2_even_sf_sql("h", 2) + ", 6) AS p_value, " + _sig(chi2_even_sf_sql("h", 2)) + """ AS significance
FROM (SELECT CAST(count(*) - 1 AS BIGINT) AS df,
  (12.0 / (any_value(tot_n) * (any_value(tot_n) + 1)) * sum(r_g * r_g / n_g) - 3 * (any_value(tot_n) + 1))
        / (1 - any_value("T") / (pow(any_value(tot_n), 3) - any_value(tot_n))) AS h
FROM rs, t, ties)""")
def h04(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return H.kruskal_wallis(li, "l_quantity", "l_returnflag").withColumn("h", rnd("h", 6)).withColumn("p_value", rnd("p_value", 6))


@plan("h05_levene_median", "H05", _anova_sql("""
SELECT o.o_orderpriority, count(*) AS n, avg(abs(o_totalprice - med)) AS mean, var_samp(abs(o_totalprice - med)) AS var
FROM orders o JOIN (SELECT o_orderpriority, median(o_totalprice) AS med FROM orders GROUP BY 1) m
  ON o.o_orderpriority = m.o_orderpriority GROUP BY 1""") + """
SELECT CAST(k - 1 AS BIGINT) AS df_between, CAST(tot_n - k AS BIGINT) AS df_within,
  round((ssb / (k - 1)) / (ssw / (tot_n - k)), 9) AS w, round(p, 6) AS p_value,
  """ + _sig("p") + " AS significance FROM (SELECT *, " + f4_sf_sql(_F, "tot_n - k") + " AS p FROM s)")
def h05(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (H.levene_median(o, "o_totalprice", "o_orderpriority").withColumn("w", rnd("w", 9))
            .withColumn("p_value", rnd("p_value", 6)))


@plan("h06_mann_whitney", "H06,Q01", f"""
WITH b AS (SELECT o_orderstatus AS g, o_totalprice AS x FROM orders WHERE o_orderstatus IN ('F', 'O')),
r AS (SELECT g, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM b),
s AS (SELECT count_if(g = 'F')::DOUBLE AS n1, count(*)::DOUBLE AS "N", sum(rk) FILTER (WHERE g = 'F') AS r1 FROM r),
t AS (SELECT sum(pow(c, 3) - c) AS "T" FROM (SELECT count(*)::DOUBLE AS c FROM b GROUP BY x)),
u AS (SELECT n1, "N" - n1 AS n2, "N", r1 - n1 * (n1 + 1) / 2 AS u1, "T" FROM s, t),
z AS (SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (("N" + 1) - "T" / ("N" * ("N" - 1)))) AS z
      FROM u)
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(u1, 6) AS u, round(z, 9) AS z,
  round((SELECT median(x) FROM b WHERE g = 'F'), 6) AS median_a, round((SELECT median(x) FROM b WHERE g = 'O'), 6) AS median_b,
  round(2 * {DI.norm_sf_sql('z')}, 9) AS p_value,
  CASE WHEN 2 * {DI.norm_sf_sql('z')} < 0.05 THEN 'significant' ELSE 'not significant' END AS significance FROM z""")
def h06(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = H.mann_whitney(o, "o_totalprice", "o_orderstatus", "F", "O")
    return out.select("n1", "n2", rnd("u", 6).alias("u"), rnd("z", 9).alias("z"), rnd("median_a", 6).alias("median_a"),
                      rnd("median_b", 6).alias("median_b"), rnd("p_value", 9).alias("p_value"),
                      H.significance(F.col("p_value")).alias("significance"))


H07_COLS = ["l_quantity", "l_discount", "l_tax"]
_RANK = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


@plan("h07_correlation_tests", "H07", "WITH c AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, 'pearson' AS method, count(*) AS n, corr({c}, l_extendedprice) AS r FROM lineitem\n"
    f"UNION ALL SELECT '{c}', 'spearman', count(*), corr(a, b) FROM (SELECT {_RANK.format(c=c)} AS a, "
    f"{_RANK.format(c='l_extendedprice')} AS b FROM lineitem)" for c in H07_COLS) + """),
s AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c),
p AS (SELECT *, """ + t_two_sided_sql("t", "n - 2") + """ AS p FROM s)
SELECT feature, method, n, round(r, 9) + 0.0 AS r, round(t, 6) + 0.0 AS t, round(p, 6) + 0.0 AS p_value, """
      + _sig("p") + " AS significance FROM p")
def h07(spark, sf_dir):
    out = H.correlation_tests(Tables(spark, sf_dir).lineitem, "l_extendedprice", H07_COLS)
    return out.select("feature", "method", "n", rnd("r", 9).alias("r"), rnd("t", 6).alias("t"),
                      rnd("p_value", 6).alias("p_value"), "significance")


def _chi_sql(src: str, a: str, b: str, yates: bool = False) -> str:
    if yates:
        body = f"""
g AS (SELECT ra.a, rb.b, ra, rb, coalesce(c.o, 0) AS o, ra * rb / "N" AS e FROM ra CROSS JOIN rb CROSS JOIN n
      LEFT JOIN c ON c.a = ra.a AND c.b = rb.b),
x AS (SELECT sum(pow(o + least(0.5, abs(e - o)) * sign(e - o) - e, 2) / e) AS chi2 FROM g)"""
    else:
        body = """
j AS (SELECT o, ra * rb / "N" AS e FROM c JOIN ra USING (a) JOIN rb USING (b), n),
x AS (SELECT sum(pow(o - e, 2) / e) + (any_value("N") - sum(e)) AS chi2 FROM j, n)"""
    return f"""(WITH s AS (SELECT {a} AS a, {b} AS b FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
c AS (SELECT a, b, count(*) AS o FROM s GROUP BY a, b),
ra AS (SELECT a, sum(o) AS ra FROM c GROUP BY a), rb AS (SELECT b, sum(o) AS rb FROM c GROUP BY b),
n AS (SELECT sum(o)::DOUBLE AS "N", count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM c),{body}
SELECT '{a}' AS feature_a, '{b}' AS feature_b, CAST("N" AS BIGINT) AS n, CAST((r - 1) * (k - 1) AS BIGINT) AS dof,
  round(chi2, 6) AS chi2, round(sqrt(chi2 / ("N" * (least(r, k) - 1))), 9) AS cramers_v,
  chi2 AS exact_chi2 FROM x, n)"""


ORD_FLAGS = ("(SELECT CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS is_urgent, "
             "CAST(o_totalprice > 200000 AS INTEGER) AS is_big FROM orders)")


_H08_P = (f"CASE WHEN dof = 1 THEN 2 * {DI.norm_sf_sql('sqrt(exact_chi2)')} ELSE {chi2_even_sf_sql('exact_chi2', 16)} END")


@plan("h08_chi2_cramers_v", "H08,M11,M12",
      "SELECT * EXCLUDE (exact_chi2, p), round(p, 6) AS p_value, " + _sig("p") + f" AS significance FROM (SELECT *, {_H08_P} AS p FROM ("
      + _chi_sql(OC_SQL, "c_mktsegment", "o_orderpriority") + "\nUNION ALL\n" +
      _chi_sql(ORD_FLAGS, "is_urgent", "is_big", yates=True) + "))")
def h08(spark, sf_dir):
    t = Tables(spark, sf_dir)
    oc = orders_customers(t)
    a = H.chi2_independence(oc, "c_mktsegment", "o_orderpriority")
    flags = t.orders.select(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("is_urgent"),
                            (F.col("o_totalprice") > 200000).cast("int").alias("is_big"))
    b = H.chi2_independence(flags, "is_urgent", "is_big", yates=True)
    return a.unionByName(b).select("feature_a", "feature_b", "n", "dof", rnd("chi2", 6).alias("chi2"),
                                   rnd("cramers_v", 9).alias("cramers_v"), rnd("p_value", 6).alias("p_value"), "significance")


V_COLS = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]


@plan("h09_cramers_v_matrix", "H09", "\nUNION ALL\n".join(
    f"SELECT feature_a, feature_b, chi2, cramers_v FROM {_chi_sql(OC_SQL, a, b)}"
    for i, a in enumerate(V_COLS) for b in V_COLS[i + 1:]))
def h09(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    out = H.cramers_v_pairs(oc, V_COLS)
    return out.select("feature_a", "feature_b", rnd("chi2", 6).alias("chi2"), rnd("cramers_v", 9).alias("cramers_v"))


SIG_FEATURES = ["o_orderpriority", "c_mktsegment", "c_nationkey"]


@plan("h10_feature_signal", "H10", "\nUNION ALL\n".join(
    f"""SELECT feature_a AS feature, cramers_v,
  CASE WHEN cramers_v IS NULL THEN 'none' WHEN cramers_v >= 0.15 THEN 'strong' WHEN cramers_v >= 0.075 THEN 'moderate'
       ELSE 'weak' END AS strength,
  (SELECT count(DISTINCT {f}) FROM {OC_SQL}) AS cardinality,
  CASE WHEN (SELECT count(DISTINCT {f}) FROM {OC_SQL}) <= 2 THEN 'binary'
       WHEN (SELECT count(DISTINCT {f}) FROM {OC_SQL}) <= 12 THEN 'one-hot' ELSE 'frequency/target' END AS encoder
FROM {_chi_sql(OC_SQL, f, 'o_orderstatus')}""" for f in SIG_FEATURES))
def h10(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    parts = []
    for f in SIG_FEATURES:
        card = oc.agg(F.count_distinct(f).alias("cardinality"))
        r = H.chi2_independence(oc, f, "o_orderstatus").select(F.col("feature_a").alias("feature"), "cramers_v")
        r = r.withColumn("cardinality", F.lit(card.first()["cardinality"]).cast("long"))
        parts.append(r)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("feature", rnd("cramers_v", 9).alias("cramers_v"), H.signal_label(F.col("cramers_v")).alias("strength"),
                      "cardinality", H.encoder_advice(F.col("cardinality")).alias("encoder"))


@plan("h11_hypothesis_summary", "H11")
def h11(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    rows = []
    for f in SIG_FEATURES:
        kw = H.kruskal_wallis(oc, "o_totalprice", f).first()
        rows.append((f, "kruskal(o_totalprice)", float(kw["h"]), int(kw["df"]), DI.chi2_sf(float(kw["h"]), kw["df"])))
        ch = H.chi2_independence(oc, f, "o_orderstatus").first()
        rows.append((f, "chi2(o_orderstatus)", float(ch["chi2"]), int(ch["dof"]), DI.chi2_sf(float(ch["chi2"]), ch["dof"])))
    out = spark.createDataFrame(rows, "feature string, test string, statistic double, dof long, p_value double")
    return out.orderBy("p_value", "feature", "test")


@plan("h12_tukey_hsd", "H12")
def h12(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return H.tukey_hsd(o, "o_totalprice", "o_orderpriority")


@plan("h13_cohens_d", "H13", """
WITH g AS (SELECT o_orderstatus AS g, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders
           WHERE o_orderstatus IN ('F', 'O') GROUP BY 1),
a AS (SELECT * FROM g WHERE g = 'F'), b AS (SELECT * FROM g WHERE g = 'O'),
d AS (SELECT (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2)) AS d FROM a, b)
SELECT round(d, 9) + 0.0 AS d, CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small'
  WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END AS magnitude FROM d""")
def h13(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return H.cohens_d(o, "o_totalprice", "o_orderstatus", "F", "O").select(rnd("d", 9).alias("d"), "magnitude")


MODEL_SQL = """(SELECT l.quality, l.toxic AS pred_toxic, CAST(d.n_chars > 2000 AS INTEGER) AS pred_long,
  CAST(d.lang = 'en' AS INTEGER) AS pred_en FROM labels l JOIN documents d USING (doc_id))"""
MODELS = ["pred_toxic", "pred_long", "pred_en"]


def model_preds(t: Tables):
    d = t.documents.select("doc_id", "n_chars", "lang")
    return t.labels.join(d, "doc_id").select(
        "doc_id", "quality", F.col("toxic").alias("pred_toxic"), (F.col("n_chars") > 2000).cast("int").alias("pred_long"),
        (F.col("lang") == "en").cast("int").alias("pred_en"))


def _mcnemar_sql():
    parts = []
    for i, a in enumerate(MODELS):
        for b in MODELS[i + 1:]:
            parts.append(f"SELECT '{a}' AS model_a, '{b}' AS model_b, CAST(count_if({a} = quality AND {b} <> quality) AS BIGINT) AS b, "
                         f"CAST(count_if({a} <> quality AND {b} = quality) AS BIGINT) AS c FROM {MODEL_SQL}")
    body = " UNION ALL ".join(parts)
    stat = "CASE WHEN b + c = 0 THEN NULL ELSE pow(abs(b - c) - 1.0, 2) / (b + c) END"
    p = DI.erfc_sql(f"sqrt(({stat}) / 2)")
    return f"""SELECT model_a, model_b, b, c, round({stat}, 9) AS statistic, round({p}, 9) AS p_value,
  CASE WHEN {p} < 0.05 THEN 'significant' ELSE 'not significant' END AS significance FROM ({body})"""


@plan("h14_h15_mcnemar", "H14,H15", _mcnemar_sql())
def h14(spark, sf_dir):
    m = model_preds(Tables(spark, sf_dir))
    out = H.mcnemar(m, "quality", MODELS)
    return out.select("model_a", "model_b", "b", "c", rnd("statistic", 9).alias("statistic"),
                      rnd("p_value", 9).alias("p_value"), H.significance(F.col("p_value")).alias("significance"))


@plan("h16_disagreement", "H16", f"""
SELECT quality, count(*) AS n, CAST(count_if(pred_toxic = quality AND pred_long = quality) AS BIGINT) AS both_right,
  CAST(count_if(pred_toxic = quality AND pred_long <> quality) AS BIGINT) AS only_a,
  CAST(count_if(pred_toxic <> quality AND pred_long = quality) AS BIGINT) AS only_b,
  CAST(count_if(pred_toxic <> quality AND pred_long <> quality) AS BIGINT) AS both_wrong FROM {MODEL_SQL} GROUP BY 1""")
def h16(spark, sf_dir):
    m = model_preds(Tables(spark, sf_dir))
    return H.disagreement_table(m, "quality", "pred_toxic", "pred_long")


@plan("h17_ks_normality", "H17")
def h17(spark, sf_dir):
    return H.ks_normality(Tables(spark, sf_dir).orders, "o_totalprice")
