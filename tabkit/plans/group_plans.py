"""Plans for group statistics, pivots, contingency tables (G09-G28) and
joins / set operations (J01-J07, U01-U02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import pivot as PV
from .columns_plans import orders_customers
from .registry import Tables, plan, rnd, round_all

OC_SQL = "(SELECT o.*, c.c_mktsegment, c.c_acctbal, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"


@plan("g09_group_stats", "G09", f"""
SELECT c_mktsegment,
  round(avg(o_totalprice), 6) AS o_totalprice_mean, round(stddev_samp(o_totalprice), 6) AS o_totalprice_std,
  count(o_totalprice) AS o_totalprice_count, round(avg(c_acctbal), 6) AS c_acctbal_mean,
  round(stddev_samp(c_acctbal), 6) AS c_acctbal_std, count(c_acctbal) AS c_acctbal_count,
  round(median(o_totalprice), 6) AS o_totalprice_median, round(median(c_acctbal), 6) AS c_acctbal_median
FROM {OC_SQL} GROUP BY 1""")
def g09(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    return round_all(PV.group_stats(oc, ["c_mktsegment"], ["o_totalprice", "c_acctbal"]), 6)


FLAGS = ["A", "N", "R"]


@plan("g11_pivot_mean", "G11", """
SELECT l_linestatus, """ + ", ".join(
    f"round(avg(l_extendedprice) FILTER (WHERE l_returnflag = '{v}'), 6) AS {v}_mean" for v in FLAGS) + """
FROM lineitem GROUP BY 1""")
def g11(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return round_all(PV.pivot_stats(li, "l_linestatus", "l_returnflag", "l_extendedprice", aggs=("mean",), values=FLAGS), 6)


STATUSES = ["F", "O", "P"]


@plan("g12_crosstab", "G12", """
SELECT o_orderpriority, """ + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{v}') AS {v}" for v in STATUSES) + """
FROM orders GROUP BY 1""")
def g12(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return PV.crosstab(o, "o_orderpriority", "o_orderstatus", STATUSES)


@plan("g13_row_normalized", "G13", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 9) AS share
FROM orders GROUP BY 1, 2""")
def g13(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return PV.row_normalized(o, "o_orderpriority", "o_orderstatus").withColumn("share", rnd("share", 9))


QL = ["Q1", "Q2", "Q3", "Q4"]


def _qbin_sql(x: str, q: str = "q") -> str:
    return (f"CASE WHEN {x} >= {q}[1] AND {x} <= {q}[2] THEN 'Q1' WHEN {x} > {q}[2] AND {x} <= {q}[3] THEN 'Q2' "
            f"WHEN {x} > {q}[3] AND {x} <= {q}[4] THEN 'Q3' WHEN {x} > {q}[4] AND {x} <= {q}[5] THEN 'Q4' END")


def _interaction_sql(keys: list[str], label: str | None = None) -> str:
    sel = ", ".join(keys)
    lab = f"'{label}' AS pair, " if label else ""
    key_out = ", ".join(f"CAST({k} AS VARCHAR) AS key_{i + 1}" for i, k in enumerate(keys)) if label else sel
    return f"""(WITH e AS (SELECT quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1.0]) AS q FROM {OC_SQL}),
b AS (SELECT {', '.join(k for k in keys if k != 'c_acctbal_bin')}, {_qbin_sql('c_acctbal')} AS c_acctbal_bin, o_totalprice
      FROM {OC_SQL}, e)
SELECT {lab}{key_out}, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
  count(o_totalprice) AS count, round(median(o_totalprice), 6) AS median
FROM b GROUP BY {sel})"""


@plan("g14_two_way_interactions", "G14,U01",
      _interaction_sql(["c_mktsegment", "c_acctbal_bin"], "segment_x_balance") + "\nUNION ALL\n" +
      _interaction_sql(["o_orderpriority", "c_acctbal_bin"], "priority_x_balance"))
def g14(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    t1 = PV.interaction_table(oc, ["c_mktsegment", "c_acctbal"], "o_totalprice", {"c_acctbal": 4}, {"c_acctbal": QL})
    t2 = PV.interaction_table(oc, ["o_orderpriority", "c_acctbal"], "o_totalprice", {"c_acctbal": 4}, {"c_acctbal": QL})
    out = PV.union_interactions([("segment_x_balance", t1), ("priority_x_balance", t2)], ["key_1", "key_2"])
    return round_all(out, 6)


@plan("g15_three_way_interaction", "G15", _interaction_sql(["c_mktsegment", "o_orderpriority", "c_acctbal_bin"]))
def g15(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    out = PV.interaction_table(oc, ["c_mktsegment", "o_orderpriority", "c_acctbal"], "o_totalprice",
                               {"c_acctbal": 4}, {"c_acctbal": QL})
    return round_all(out, 6)


def _curve_sql(bins=10):
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    cases = " ".join(
        (f"WHEN c_acctbal >= q[{i + 1}] AND c_acctbal <= q[{i + 2}] THEN {i}" if i == 0 else
         f"WHEN c_acctbal > q[{i + 1}] AND c_acctbal <= q[{i + 2}] THEN {i}") for i in range(bins))
    return f"""
WITH e AS (SELECT quantile_cont(c_acctbal, [{probs}]) AS q FROM {OC_SQL}),
b AS (SELECT o_orderpriority, o_totalprice, q, CASE {cases} END AS bin FROM {OC_SQL}, e)
SELECT o_orderpriority, bin, round((q[bin + 1] + q[bin + 2]) / 2, 6) AS mid, round(avg(o_totalprice), 6) AS mean_y,
  count(*) AS count
FROM b WHERE bin IS NOT NULL GROUP BY o_orderpriority, bin, q"""


@plan("g16_binned_curve", "G16", _curve_sql())
def g16(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    return round_all(PV.binned_curve(oc, "c_acctbal", "o_totalprice", "o_orderpriority", 10), 6)


@plan("g17_class_counts", "G17", """
WITH c AS (SELECT quality, count(*) AS count FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT quality, count, round(count / sum(count) OVER (), 9) AS share,
  round(count / max(count) OVER (), 9) AS ratio_to_majority,
  round(max(count) OVER () / min(count) OVER (), 9) AS imbalance_ratio,
  CASE quality WHEN 0 THEN 0 WHEN 1 THEN 1 END AS "order"
FROM c""")
def g17(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    out = PV.class_counts(lab, "quality", order=[0, 1])
    return out.select("quality", "count", *[rnd(c, 9).alias(c) for c in ("share", "ratio_to_majority", "imbalance_ratio")],
                      "order")


@plan("g18_label_coverage", "G18,J04", """
WITH j AS (SELECT d.lang, l.doc_id IS NOT NULL AS lab FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT lang, count_if(lab) AS n_labelled, count_if(NOT lab) AS n_unlabelled FROM j GROUP BY 1)
SELECT lang, CAST(n_labelled AS BIGINT) AS n_labelled, CAST(n_unlabelled AS BIGINT) AS n_unlabelled, round(n_labelled / sum(n_labelled) OVER (), 9) AS share_labelled,
  round(n_unlabelled / sum(n_unlabelled) OVER (), 9) AS share_unlabelled,
  round(n_labelled / sum(n_labelled) OVER () - n_unlabelled / sum(n_unlabelled) OVER (), 9) + 0.0 AS diff
FROM c""")
def g18(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", F.lit(1).alias("lab")), "doc_id", "left")
    out = PV.coverage_by_feature(j, "lang", F.col("lab").isNotNull())
    return out.select("lang", "n_labelled", "n_unlabelled",
                      *[rnd(c, 9).alias(c) for c in ("share_labelled", "share_unlabelled", "diff")])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@plan("g19_monthly_by_class", "G19", """
SELECT CAST(date_trunc('month', ts) AS VARCHAR) AS month, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{v}') AS {v}" for v in EVENT_TYPES) + """, count(*) AS total
FROM events GROUP BY 1""")
def g19(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    out = PV.monthly_by_class(ev, "ts", "event_type", EVENT_TYPES)
    return out.withColumn("month", F.col("month").cast("string"))


@plan("g20_hourly_share", "G20", """
WITH c AS (SELECT hour(ts) AS hour, count(*) AS n, count_if(event_type = 'error') AS n_flag FROM events GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))
SELECT g.hour, coalesce(n, 0) AS n, CAST(coalesce(n_flag, 0) AS BIGINT) AS n_flag,
  round(CASE WHEN coalesce(n, 0) = 0 THEN NULL ELSE n_flag / n END, 9) AS share
FROM g LEFT JOIN c ON g.hour = c.hour""")
def g20(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return PV.hourly_share(ev, F.hour("ts"), F.col("event_type") == "error").withColumn("share", rnd("share", 9))


@plan("g21_risky_pairs", "G21", f"""
SELECT c_mktsegment, o_orderpriority, count(*) AS total, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS hits,
  round(count_if(o_orderstatus = 'F') / count(*), 9) AS share
FROM {OC_SQL} GROUP BY 1, 2 HAVING count(*) >= 20
ORDER BY count_if(o_orderstatus = 'F') / count(*) DESC, total DESC, c_mktsegment, o_orderpriority LIMIT 10""")
def g21(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    out = PV.risky_pairs(oc, "c_mktsegment", "o_orderpriority", F.col("o_orderstatus") == "F", 20, 10)
    return out.withColumn("share", rnd("share", 9))


@plan("g22_interaction_share_matrix", "G22,J05", f"""
WITH a AS (SELECT c_nationkey FROM {OC_SQL} GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 8),
b AS (SELECT o_orderpriority FROM {OC_SQL} GROUP BY 1 ORDER BY count(*) DESC, o_orderpriority LIMIT 3)
SELECT c_nationkey, o_orderpriority, count(*) AS n, round(avg(CAST(o_orderstatus = 'F' AS DOUBLE)), 9) AS share
FROM {OC_SQL} WHERE c_nationkey IN (SELECT * FROM a) AND o_orderpriority IN (SELECT * FROM b) GROUP BY 1, 2""")
def g22(spark, sf_dir):
    oc = orders_customers(Tables(spark, sf_dir))
    out = PV.interaction_share_matrix(oc, "c_nationkey", "o_orderpriority", F.col("o_orderstatus") == "F", 8)
    # the plan keeps the 3 most frequent priorities (a rectangular top-N x top-M grid)
    top_b = PV.top_categories(oc, "o_orderpriority", 3)
    return out.join(F.broadcast(top_b), "o_orderpriority", "left_semi").withColumn("share", rnd("share", 9))


@plan("g23_flag_class_delta", "G23", """
WITH c AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
g AS (SELECT l_linestatus, sum(n) AS group_n FROM c GROUP BY 1),
k AS (SELECT l_returnflag, sum(n) / (SELECT sum(n) FROM c) AS global_share FROM c GROUP BY 1)
SELECT c.l_returnflag, c.l_linestatus, n, CAST(group_n AS BIGINT) AS group_n, round(global_share, 9) AS global_share,
  round(n / group_n, 9) AS share, round((n / group_n - global_share) * 100, 9) + 0.0 AS delta_pts
FROM c JOIN g ON c.l_linestatus = g.l_linestatus JOIN k ON c.l_returnflag = k.l_returnflag WHERE group_n >= 50""")
def g23(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = PV.flag_class_delta(li, "l_linestatus", "l_returnflag", 50)
    return out.select("l_returnflag", "l_linestatus", "n", F.col("group_n").cast("bigint").alias("group_n"),
                      *[rnd(c, 9).alias(c) for c in ("global_share", "share", "delta_pts")])


@plan("g24_majority_value", "G24", """
WITH c AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_returnflag) AS rn FROM c)
SELECT l_partkey, l_returnflag FROM r WHERE rn = 1""")
def g24(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return PV.majority_value(li, "l_partkey", "l_returnflag")


@plan("g25_total_mean_per_key", "G25", """
SELECT l_suppkey, round(sum(l_extendedprice), 4) AS total, round(avg(l_extendedprice), 6) AS mean
FROM lineitem GROUP BY 1""")
def g25(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = PV.total_mean_per_key(li, "l_suppkey", "l_extendedprice")
    return out.select("l_suppkey", rnd("total", 4).alias("total"), rnd("mean", 6).alias("mean"))


@plan("g26_duplicates", "G26", """
SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct, count(*) - count(DISTINCT text) AS n_duplicates,
  round(count(DISTINCT text) / count(*), 9) AS distinct_share FROM documents""")
def g26(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return PV.duplicate_stats(d, ["text"]).withColumn("distinct_share", rnd("distinct_share", 9))


@plan("g28_cluster_profile", "G28", """
SELECT label, count(*) AS size, round(avg(embedding[1]::DOUBLE), 9) AS e0_mean, round(avg(embedding[2]::DOUBLE), 9) AS e1_mean,
  round(avg(embedding[3]::DOUBLE), 9) AS e2_mean FROM embeddings GROUP BY 1""")
def g28(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select("label", *[F.col("embedding")[i].alias(f"e{i}") for i in range(3)])
    return round_all(PV.cluster_profile(e, "label", ["e0", "e1", "e2"]), 9)


# ---------------------------------------------------------------- joins / sets

@plan("j01_left_join_text_key", "J01", """
WITH p AS (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
SELECT li.l_returnflag, p.l_linestatus AS pair_status, count(*) AS n
FROM lineitem li LEFT JOIN p ON li.l_returnflag = p.l_returnflag GROUP BY 1, 2""")
def j01(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    pairs = li.select("l_returnflag", F.col("l_linestatus").alias("pair_status")).distinct()
    return J.left_join(li.select("l_returnflag"), pairs, "l_returnflag").groupBy("l_returnflag", "pair_status") \
        .agg(F.count(F.lit(1)).alias("n"))


@plan("j02_row_aligned_join", "J02", """
SELECT o_orderkey, o_orderpriority, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def j02(spark, sf_dir):
    t = Tables(spark, sf_dir)
    left = t.orders.select("o_orderkey", "o_orderpriority", "o_custkey")
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return J.align_columns(left, right, "o_custkey").drop("o_custkey")


PRIORITY_WEIGHT = {"1-URGENT": 5.0, "2-HIGH": 4.0, "3-MEDIUM": 3.0, "4-NOT SPECIFIED": 2.0, "5-LOW": 1.0}


@plan("j03_broadcast_lookup", "J03", """
WITH w(o_orderpriority, weight) AS (VALUES ('1-URGENT', 5.0::DOUBLE), ('2-HIGH', 4.0), ('3-MEDIUM', 3.0),
  ('4-NOT SPECIFIED', 2.0), ('5-LOW', 1.0))
SELECT o_orderkey, weight, round(weight * o_totalprice, 4) AS weighted FROM orders LEFT JOIN w USING (o_orderpriority)""")
def j03(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = J.lookup(o, "o_orderpriority", PRIORITY_WEIGHT, "weight")
    return out.select("o_orderkey", "weight", rnd(F.col("weight") * F.col("o_totalprice"), 4).alias("weighted"))


@plan("j04_full_outer_alignment", "J04", """
WITH a AS (SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1),
b AS (SELECT source, count(*) AS n FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1 GROUP BY 1)
SELECT coalesce(a.source, b.source) AS source, coalesce(a.n, 0) AS english, coalesce(b.n, 0) AS toxic
FROM a FULL OUTER JOIN b ON a.source = b.source""")
def j04(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.documents.where(F.col("lang") == "en").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    b = t.documents.join(t.labels.where(F.col("toxic") == 1), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return J.align_distributions(a, b, "source", "english", "toxic")


@plan("j05_keep_top_categories", "J05", """
WITH t AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 10)
SELECT l_partkey, count(*) AS n, round(sum(l_quantity), 4) AS qty FROM lineitem WHERE l_partkey IN (SELECT * FROM t) GROUP BY 1""")
def j05(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    kept = J.keep_top(li, "l_partkey", 10)
    return kept.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("l_quantity"), 4).alias("qty"))


@plan("j06_rows_not_in_sample", "J06,U02", """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def j06(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.rows_not_in(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), "doc_id")


@plan("j07_grid_expand", "J07", """
WITH a AS (SELECT l_returnflag, count(*) AS n, avg(l_discount) AS d FROM lineitem GROUP BY 1),
g(t) AS (VALUES (0.02::DOUBLE), (0.04), (0.06), (0.08))
SELECT l_returnflag, t AS threshold, n, round(d - t, 9) + 0.0 AS gap FROM a, g""")
def j07(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    a = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("d"))
    g = J.expand_grid(a, "threshold", [0.02, 0.04, 0.06, 0.08])
    return g.select("l_returnflag", "threshold", "n", rnd(F.col("d") - F.col("threshold"), 9).alias("gap"))


@plan("u01_union_labelled", "U01", """
SELECT 'orders' AS source, CAST(date_trunc('year', o_orderdate) AS VARCHAR) AS year, count(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'lineitem', CAST(date_trunc('year', l_shipdate) AS VARCHAR), count(*) FROM lineitem GROUP BY 2""")
def u01(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.orders.groupBy(F.date_trunc("year", "o_orderdate").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    b = t.lineitem.groupBy(F.date_trunc("year", "l_shipdate").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return J.union_labelled([("orders", a), ("lineitem", b)], columns=["year", "n"])


@plan("u02_minus_all", "U02", """
SELECT lang, source FROM documents EXCEPT ALL SELECT d.lang, d.source FROM documents d JOIN labels l USING (doc_id)""")
def u02(spark, sf_dir):
    t = Tables(spark, sf_dir)
    allp = t.documents.select("lang", "source")
    lab = t.documents.join(t.labels, "doc_id").select("lang", "source")
    return J.minus_all(allp, lab)
