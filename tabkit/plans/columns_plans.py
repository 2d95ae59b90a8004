"""Plans for projections, predicates, scalar and date/time functions (P, T)
plus the flagship pivot (S03 -> P01/P02/P08 -> G10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins as B
from ..functions import columns as C
from ..functions import dates as D
from ..operators import pivot as PV
from .registry import Tables, plan, rnd

# Fixed values of the plans (chosen for the generated tables).
SIZE_EDGES = [0, 50000, 150000, 300000, 600000]
SIZE_LABELS = ["small", "medium", "large", "xlarge"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
POINTS = {"a": (10.0, 10.0), "b": (40.0, 15.0), "c": (25.0, 20.0)}
PRIORITY_RANK = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}
ZONE = "America/Sao_Paulo"


def orders_customers(t: Tables):
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal", "c_nationkey")
    return t.orders.join(cust, "o_custkey")


def _size_case(x: str) -> str:
    parts = []
    for i, lab in enumerate(SIZE_LABELS):
        lo, hi = SIZE_EDGES[i], SIZE_EDGES[i + 1]
        low = f"{x} >= {lo}" if i == 0 else f"{x} > {lo}"
        parts.append(f"WHEN {low} AND {x} <= {hi} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def _pivot_sql() -> str:
    cols = []
    for lab in SIZE_LABELS:
        f = f"FILTER (WHERE size_bin = '{lab}')"
        cols += [f"round(avg(o_totalprice) {f}, 4) AS {lab}_mean",
                 f"round(quantile_cont(o_totalprice, 0.5) {f}, 4) AS {lab}_median",
                 f"count(o_totalprice) {f} AS {lab}_count"]
    return f"""
WITH b AS (
  SELECT c.c_mktsegment, o.o_totalprice, {_size_case('o.o_totalprice')} AS size_bin
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT c_mktsegment, {', '.join(cols)}
FROM b WHERE size_bin IS NOT NULL GROUP BY c_mktsegment"""


def flagship(spark, sf_dir):
    """S03 read -> P01 ratio, P02 log, P08 size bins -> G10 pivot
    (mean/median/count of order value by market segment x size bin)."""
    t = Tables(spark, sf_dir)
    df = orders_customers(t)
    df = C.ratio_features(df, {"price_to_balance": ("o_totalprice", "c_acctbal")})
    df = C.log_features(df, ["o_totalprice"])
    df = B.fixed_bins(df, "o_totalprice", SIZE_EDGES, SIZE_LABELS, out="size_bin")
    wide = PV.pivot_stats(df, "c_mktsegment", "size_bin", "o_totalprice",
                          aggs=("mean", "median", "count"), values=SIZE_LABELS)
    return wide.select("c_mktsegment", *[
        (rnd(c, 4) if not c.endswith("_count") else F.col(c)).alias(c)
        for c in wide.columns if c != "c_mktsegment"])


plan("g10_pivot_segment_by_size", "S03,P01,P02,P08,G10", _pivot_sql())(flagship)


@plan("p01_ratio_features", "P01", """
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END, 6) AS price_per_qty,
  round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 6) AS disc_over_tax
FROM lineitem""")
def p01(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = C.ratio_features(li, {"price_per_qty": ("l_extendedprice", "l_quantity"),
                                "disc_over_tax": ("l_discount", "l_tax"),
                                "skipped": ("l_extendedprice", "no_such_column")})
    return out.select("l_orderkey", "l_linenumber", rnd("price_per_qty"), rnd("disc_over_tax")) \
        .toDF("l_orderkey", "l_linenumber", "price_per_qty", "disc_over_tax")


@plan("p02_log_clipped", "P02", """
SELECT l_orderkey, l_linenumber,
  round(ln(1 + CASE WHEN l_quantity - 25 < 0 THEN 0 ELSE l_quantity - 25 END), 9) AS log_qty_over_25,
  round(ln(1 + l_extendedprice), 9) AS log_l_extendedprice
FROM lineitem""")
def p02(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("qty_over_25", F.col("l_quantity") - 25)
    out = C.log_features(li, ["qty_over_25", "l_extendedprice", "missing_col"])
    return out.select("l_orderkey", "l_linenumber", rnd("log_qty_over_25", 9).alias("log_qty_over_25"),
                      rnd("log_l_extendedprice", 9).alias("log_l_extendedprice"))


@plan("p03_plain_logs", "P03", """
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 9) AS ln_price,
       round(ln(l_discount + 1), 9) AS ln1p_discount
FROM lineitem""")
def p03(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", rnd(C.plain_log("l_extendedprice"), 9).alias("ln_price"),
                     rnd(C.plain_log("l_discount", plus_one=True), 9).alias("ln1p_discount"))


def _dist_sql(name, px, py):
    return f"sqrt(pow(p_size - {px}, 2) + pow(p_retailprice / 100.0 - {py}, 2))"


@plan("p04_p05_point_distances", "P04,P05", f"""
WITH d AS (
  SELECT p_partkey, {_dist_sql('a', 10.0, 10.0)} AS da, {_dist_sql('b', 40.0, 15.0)} AS db,
         {_dist_sql('c', 25.0, 20.0)} AS dc FROM part)
SELECT p_partkey, round(da, 9) AS dist_a, round(db, 9) AS dist_b, round(dc, 9) AS dist_c,
  round(least(da, db, dc), 9) AS dist_min,
  CASE WHEN da <= db AND da <= dc THEN 'a' WHEN db <= dc THEN 'b' ELSE 'c' END AS nearest
FROM d""")
def p04(spark, sf_dir):
    part = Tables(spark, sf_dir).part.withColumn("y", F.col("p_retailprice") / 100.0)
    out = C.point_distances(part, "p_size", "y", POINTS)
    return out.select("p_partkey", *[rnd(c, 9).alias(c) for c in ("dist_a", "dist_b", "dist_c", "dist_min")],
                      "nearest")


@plan("p06_polynomial", "P06", """
SELECT l_orderkey, l_linenumber, round(pow(l_quantity, 2), 6) AS l_quantity_sq,
  round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount
FROM lineitem""")
def p06(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = C.polynomial_features(li, [["l_quantity"], ["l_quantity", "l_discount"],
                                     ["l_quantity", "l_discount", "l_tax"]])
    return out.select("l_orderkey", "l_linenumber", rnd("l_quantity_sq").alias("l_quantity_sq"),
                      rnd("l_quantity_x_l_discount").alias("l_quantity_x_l_discount"))


@plan("p07_binary_flags", "P07", """
SELECT l_orderkey, l_linenumber, CAST(coalesce(l_returnflag = 'R', false) AS INTEGER) AS is_returned,
  CAST(coalesce(l_linestatus = 'O', false) AS INTEGER) AS is_open
FROM lineitem""")
def p07(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = C.binary_flags(li, [{"column": "l_returnflag", "value": "R", "new_column": "is_returned"},
                              {"column": "l_linestatus", "value": "O", "new_column": "is_open"}])
    return out.select("l_orderkey", "l_linenumber", "is_returned", "is_open")


@plan("p08_fixed_bins", "P08", f"""
SELECT o_orderkey, {_size_case('o_totalprice')} AS size_bin FROM orders""")
def p08(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return B.fixed_bins(o, "o_totalprice", SIZE_EDGES, SIZE_LABELS, out="size_bin").select("o_orderkey", "size_bin")


@plan("p09_quantile_bins", "P09", """
WITH e AS (SELECT quantile_cont(o_totalprice, [0, 0.25, 0.5, 0.75, 1.0]) AS q FROM orders)
SELECT o_orderkey, CASE
  WHEN o_totalprice >= q[1] AND o_totalprice <= q[2] THEN 'Q1'
  WHEN o_totalprice > q[2] AND o_totalprice <= q[3] THEN 'Q2'
  WHEN o_totalprice > q[3] AND o_totalprice <= q[4] THEN 'Q3'
  WHEN o_totalprice > q[4] AND o_totalprice <= q[5] THEN 'Q4' END AS price_q
FROM orders, e""")
def p09(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out, _ = B.quantile_bins(o, "o_totalprice", 4, labels=["Q1", "Q2", "Q3", "Q4"], out="price_q")
    return out.select("o_orderkey", "price_q")


@plan("p10_ordinal_map", "P10", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
  WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 END AS priority_rank
FROM orders""")
def p10(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return C.ordinal_map(o, "o_orderpriority", PRIORITY_RANK, out="priority_rank").select("o_orderkey", "priority_rank")


@plan("p11_one_hot", "P11,V-F07", """
SELECT c_custkey,
  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS seg_BUILDING,
  CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS seg_FURNITURE,
  CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS seg_HOUSEHOLD,
  CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS seg_MACHINERY
FROM customer""")
def p11(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    vals = C.fit_one_hot_values(c, "c_mktsegment")
    out = C.one_hot(c, "c_mktsegment", vals, prefix="seg", drop_first=True)
    return out.select("c_custkey", *[x for x in out.columns if x.startswith("seg_")])


@plan("p12_select_features", "P12", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, 0.0::DOUBLE AS missing_feature FROM lineitem""")
def p12(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return C.select_features(li, ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "missing_feature"],
                             fill_missing=0.0)


@plan("p13_clean_names", "P13", """
SELECT c_custkey AS cust_key, c_acctbal AS "balance_(usd)_lt_0", c_mktsegment AS market_segment FROM customer""")
def p13(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("Cust Key"),
                                              F.col("c_acctbal").alias("Balance [USD] <0"),
                                              F.col("c_mktsegment").alias("Market  Segment"))
    return C.clean_column_names(c)


@plan("p14_recode", "P14", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_urgent,
  CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS status_merged,
  CAST(o_totalprice > 200000 AS INTEGER) AS is_big
FROM orders""")
def p14(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey",
                    C.recode("o_orderpriority", [(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1)],
                             otherwise=0).alias("is_urgent"),
                    C.recode("o_orderstatus", [(F.col("o_orderstatus") == "P", "O")]).alias("status_merged"),
                    (F.col("o_totalprice") > 200000).cast("int").alias("is_big"))


@plan("p15_row_predicates", "P15", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_discount <> 0 AND l_quantity < 45 AND l_returnflag <> 'N' AND l_extendedprice BETWEEN 1000 AND 90000""")
def p15(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.where((F.col("l_discount") != 0) & (F.col("l_quantity") < 45) & (F.col("l_returnflag") != "N")
                    & F.col("l_extendedprice").between(1000, 90000)).select("l_orderkey", "l_linenumber")


@plan("p16_fill_missing", "P16,J01", """
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def p16(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return j.na.fill({"quality": -1, "toxic": 0}).select("doc_id", "lang", "quality", "toxic")


@plan("p16_drop_missing", "P16", """
SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""")
def p16b(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return j.na.drop(subset=["quality", "toxic"])


@plan("p17_leakage_drop", "P17", """
SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d""")
def p17(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.join(t.labels, "doc_id", "left")
    return j.drop("text", "quality", "toxic")


@plan("p18_zscore_flags", "P18", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / sd, 9) AS z_o_totalprice,
  CAST(abs((o_totalprice - m) / sd) > 2 AS INTEGER) AS out_o_totalprice
FROM orders, s""")
def p18(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = C.zscore_flags(o, ["o_totalprice"], k=2.0)
    return out.select("o_orderkey", rnd("z_o_totalprice", 9).alias("z_o_totalprice"), "out_o_totalprice")


@plan("p19_derived_amount", "P19", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge
FROM lineitem""")
def p19(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"))


@plan("p20_row_key", "P20", """
SELECT p_partkey, concat_ws('|', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR),
  CAST(round(p_retailprice, 12) AS VARCHAR)) AS row_key FROM part""")
def p20(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", F.concat_ws("|", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"),
                                             F.round("p_retailprice", 12).cast("string")).alias("row_key"))


@plan("p21_rescale_array", "P21", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE / 255.0)), 9) AS scaled_sum,
  round(list_max(list_transform(embedding, lambda x: x::DOUBLE / 255.0)), 12) AS scaled_max
FROM embeddings""")
def p21(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    s = C.rescale_array(F.transform("embedding", lambda x: x.cast("double")), 255.0)
    return e.select("vec_id", F.size("embedding").alias("n"),
                    rnd(F.aggregate(s, F.lit(0.0), lambda a, x: a + x), 9).alias("scaled_sum"),
                    rnd(F.array_max(s), 12).alias("scaled_max"))


@plan("p22_prediction_interval", "P22", """
WITH g AS (SELECT l_returnflag, avg(l_extendedprice) AS pred, stddev_samp(l_extendedprice) AS sd
           FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, round(pred, 4) AS pred, round(pred - 1.96 * sd / sqrt(5), 4) AS lower,
  round(pred + 1.96 * sd / sqrt(5), 4) AS upper FROM g""")
def p22(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    g = li.groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("pred"),
                                       F.stddev_samp("l_extendedprice").alias("sd"))
    lo, hi = C.prediction_interval("pred", "sd", folds=5, z=1.96)
    return g.select("l_returnflag", rnd("pred", 4).alias("pred"), rnd(lo, 4).alias("lower"), rnd(hi, 4).alias("upper"))


@plan("p23_threshold_decision", "P23", """
SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) AS decision FROM lineitem""")
def p23(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", C.threshold_decision("l_discount", 0.05).alias("decision"))


@plan("p24_cap_at_quantile", "P24", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.99) AS q99 FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_extendedprice > q99 THEN q99 ELSE l_extendedprice END, 6) AS capped,
  CAST(l_extendedprice < q99 AS INTEGER) AS kept
FROM lineitem, q""")
def p24(spark, sf_dir):
    from ..operators.order import quantile_values
    li = Tables(spark, sf_dir).lineitem
    q99 = quantile_values(li, "l_extendedprice", [0.99])[0]
    return li.select("l_orderkey", "l_linenumber", rnd(C.cap_at("l_extendedprice", F.lit(q99)), 6).alias("capped"),
                     (F.col("l_extendedprice") < F.lit(q99)).cast("int").alias("kept"))


# ---------------------------------------------------------------- date/time (T)

def _local(ts="ts"):
    return f"timezone('{ZONE}', {ts} AT TIME ZONE 'UTC')"


@plan("t01_t04_time_features", "T01,T02,T03,T04", f"""
WITH l AS (SELECT event_id, {_local()} AS lt FROM events)
SELECT event_id, CAST(hour(lt) AS INTEGER) AS hour, CAST(isodow(lt) - 1 AS INTEGER) AS weekday, CAST(month(lt) AS INTEGER) AS month,
  round(sin(2 * pi() * hour(lt) / 24), 9) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(lt) / 24), 9) + 0.0 AS hour_cos,
  CAST((hour(lt) BETWEEN 6 AND 7) OR (hour(lt) BETWEEN 18 AND 19) AS INTEGER) AS handover,
  CAST(hour(lt) >= 19 OR hour(lt) < 7 AS INTEGER) AS night_shift
FROM l""")
def t01(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    out = D.time_features(ev, "ts", tz=ZONE, source_tz="UTC", handover=[(6, 7), (18, 19)])
    return out.select("event_id", "hour", "weekday", "month", rnd("hour_sin", 9).alias("hour_sin"),
                      rnd("hour_cos", 9).alias("hour_cos"), "handover", "night_shift")


@plan("t05_day_parts", "T05", """
SELECT event_id, dayname(ts) AS day_name, CAST(day(ts) AS INTEGER) AS day_of_month, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(day(ts) > 15 AS INTEGER) AS second_half, CAST(hour(ts) >= 12 AS INTEGER) AS after_noon
FROM events""")
def t05(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return D.day_parts(ev, "ts").select("event_id", "day_name", "day_of_month", "hour", "second_half", "after_noon")


@plan("t06_month_bucket", "T06", """
SELECT CAST(date_trunc('month', l_shipdate) AS VARCHAR) AS month, count(*) AS n FROM lineitem GROUP BY 1""")
def t06(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.select(D.month_bucket("l_shipdate").alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("m").cast("string").alias("month"), "n"))
