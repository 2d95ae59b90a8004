"""Plans for ranking, windows, time series (Q), sort/top-k (O) and splits (B, G27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins as B
from ..functions import dates as D
from ..operators import order as O
from ..operators import split as S
from ..operators import timeseries as TS
from ..operators.metrics import regression_metrics
from ..operators.pivot import split_class_shares
from .registry import Tables, plan, rnd, round_all

EV_ORDER = ["ts", "event_id"]
USER_W = "PARTITION BY user_id ORDER BY ts, event_id"


def _h(k: str) -> str:
    return f"('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT"


@plan("q02_lag_lead", "Q02", f"""
WITH w AS (SELECT event_id, value, lag(value) OVER ({USER_W}) AS value_x, lead(value) OVER ({USER_W}) AS value_y
           FROM events)
SELECT * FROM w WHERE value_x IS NOT NULL AND value_y IS NOT NULL""")
def q02(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return TS.lag_lead(ev, "value", EV_ORDER, ["user_id"]).select("event_id", "value", "value_x", "value_y")


@plan("q03_difference", "Q03", f"""
SELECT event_id, round(value - lag(value) OVER ({USER_W}), 9) + 0.0 AS value_diff FROM events""")
def q03(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return TS.difference(ev, "value", EV_ORDER, ["user_id"]).select("event_id", rnd("value_diff", 9).alias("value_diff"))


@plan("q04_rolling_mean", "Q04", f"""
SELECT event_id, round(avg(value) OVER ({USER_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS value_roll3
FROM events""")
def q04(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return TS.rolling_mean(ev, "value", EV_ORDER, 3, ["user_id"]).select("event_id", rnd("value_roll3", 9).alias("value_roll3"))


@plan("q05_past_windows", "Q05", f"""
WITH w AS (SELECT event_id, value, list(value) OVER ({USER_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS win
           FROM events)
SELECT event_id, round(list_sum(win), 9) AS w_sum, win[1] AS w_first, win[3] AS w_last, value AS y
FROM w WHERE len(win) = 3""")
def q05(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    out = TS.past_windows(ev, "value", EV_ORDER, past=3, future=1, series=["user_id"])
    return out.select("event_id", rnd(F.aggregate("window", F.lit(0.0), lambda a, x: a + x), 9).alias("w_sum"),
                      F.col("window")[0].alias("w_first"), F.col("window")[2].alias("w_last"), "y")


@plan("q06_autocorrelation", "Q06", """
WITH s AS (SELECT date_trunc('hour', ts) AS h, count(*)::DOUBLE AS x FROM events GROUP BY 1),
p AS (SELECT row_number() OVER (ORDER BY h) AS pos, x - avg(x) OVER () AS xc FROM s),
d AS (SELECT sum(xc * xc) AS den FROM p),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(0, 25))
SELECT k.k, round(sum(a.xc * b.xc) / any_value(den), 9) + 0.0 AS acf
FROM p a CROSS JOIN k JOIN p b ON b.pos = a.pos + k.k CROSS JOIN d GROUP BY k.k""")
def q06(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    hourly = ev.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count(F.lit(1)).cast("double").alias("x"))
    return TS.autocorrelation(hourly, "x", ["h"], 24).select("k", rnd("acf", 9).alias("acf"))


@plan("q07_partial_autocorrelation", "Q07")
def q07(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    hourly = ev.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count(F.lit(1)).cast("double").alias("x"))
    acf = sorted(TS.autocorrelation(hourly, "x", ["h"], 24).collect())  # 25 numbers
    pacf = TS.pacf_from_acf([r["acf"] for r in acf])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(pacf)], "k int, pacf double")


LI_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]  # unique row order


def _unit_price(li):
    from ..functions.columns import scalars
    return scalars(li.agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("u")))["u"]


@plan("q08_batch_metrics", "Q08,V01", """
WITH u AS (SELECT avg(l_extendedprice / l_quantity) AS u FROM lineitem),
b AS (SELECT l_extendedprice AS y, l_quantity * u AS p,
        ntile(10) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS batch FROM lineitem, u)
SELECT CAST(batch AS INTEGER) AS batch, count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(avg(abs(y - p)), 6) AS mae,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
  round(avg(abs((y - p) / y)) * 100, 6) AS mape
FROM b GROUP BY batch""")
def q08(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    u = _unit_price(li)
    scored = li.select(*LI_ORDER, F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.lit(u)).alias("p"))
    batched = TS.sequential_batches(scored, LI_ORDER, 10)
    m = regression_metrics(batched, "y", "p", group_cols=["batch"], as_percent=True)
    return round_all(m.select("batch", "n", "rmse", "mae", "r2", "mape"), 6)


@plan("q09_cumulative_sum", "Q09", """
SELECT l_orderkey, l_linenumber,
  sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_quantity_cum
FROM lineitem""")
def q09(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                                               "l_shipdate", "l_quantity")
    return TS.cumulative_sum(li, "l_quantity", LI_ORDER, ["l_returnflag"]).select("l_orderkey", "l_linenumber",
                                                                                  "l_quantity_cum")


@plan("q09_exact_sums", "Q09", """
SELECT l_orderkey, l_linenumber, sum(36028797018963968 + l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS big_cum,
  (sum(CAST(l_extendedprice AS DECIMAL(20, 2)) + 10000000000000000) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::VARCHAR AS money_cum
FROM lineitem""")
def q09_exact(spark, sf_dir):
    """Integers above 2^53 and decimals: sums that a double cannot hold."""
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", (F.lit(2**55) + F.col("l_partkey")).alias("big"),
        (F.col("l_extendedprice").cast("decimal(20,2)") + F.lit(10**16).cast("decimal(20,2)")).alias("money"))
    rows = O.prefix_sum(li, ["l_linenumber", "big", "money"], ["big", "money"], ["l_orderkey"], out=["big_cum", "money_cum"])
    return rows.select("l_orderkey", "l_linenumber", "big_cum", F.col("money_cum").cast("string").alias("money_cum"))


@plan("q10_time_split", "Q10", """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train' WHEN ts < TIMESTAMP '2024-01-25' THEN 'val'
  ELSE 'test' END AS split FROM events""")
def q10(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", D.time_split("ts", "2024-01-20", "2024-01-25").alias("split"))


@plan("q11_last_fraction_split", "Q11", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM events""")
def q11(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "ts")
    return TS.last_fraction_split(ev, EV_ORDER, 0.2).select("event_id", "split")


@plan("o01_n_largest", "O01", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o01(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return O.n_extreme(o, 10, "o_totalprice", True, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@plan("o01_n_smallest", "O01", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10""")
def o01b(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return O.n_extreme(o, 10, "o_totalprice", False, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@plan("o02_multi_key_sort", "O02,Q01", """
SELECT l_orderkey, l_linenumber,
  row_number() OVER (ORDER BY l_returnflag DESC, l_quantity, l_orderkey, l_linenumber) AS pos FROM lineitem""")
def o02(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    out = O.row_positions(li, [F.col("l_returnflag").desc(), "l_quantity", "l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "pos")


@plan("o03_top_n_per_group", "O03", """
SELECT l_suppkey, l_orderkey, l_linenumber, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem) WHERE rn <= 3""")
def o03(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = O.top_n_per_group(li, ["l_suppkey"], [F.col("l_extendedprice").desc(), F.col("l_orderkey"),
                                                F.col("l_linenumber"), F.col("l_partkey")], 3)
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "rn")


@plan("o04_head_sample", "O04", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def o04(spark, sf_dir):
    return O.head_sample(Tables(spark, sf_dir).orders, "o_orderkey", 1000).select("o_orderkey", "o_totalprice")


@plan("q01_average_rank", "Q01", """
SELECT l_quantity, count(*) AS n, (sum(count(*)) OVER (ORDER BY l_quantity) - (count(*) - 1) / 2.0)::DOUBLE AS rank
FROM lineitem GROUP BY l_quantity""")
def q01(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return O.average_rank(li, "l_quantity")


# ---------------------------------------------------------------- splits (B)

@plan("b01_random_split", "B01", f"""
SELECT o_orderkey, CASE WHEN {_h('o_orderkey')} / 4294967296.0 < 0.75 THEN 'train'
  WHEN {_h('o_orderkey')} / 4294967296.0 < 0.875 THEN 'val' ELSE 'test' END AS split FROM orders""")
def b01(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return S.random_split(o, "o_orderkey", [0.75, 0.125, 0.125]).select("o_orderkey", "split")


@plan("b02_stratified_split", "B02", f"""
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY {_h('doc_id')}, doc_id)
  <= floor(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM labels WHERE quality IS NOT NULL""")
def b02(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    return S.stratified_split(lab, "doc_id", "quality", 0.2).select("doc_id", "split")


def _decile_case(x):
    return "CASE " + " ".join(
        (f"WHEN {x} >= q[{i + 1}] AND {x} <= q[{i + 2}] THEN {i}" if i == 0 else
         f"WHEN {x} > q[{i + 1}] AND {x} <= q[{i + 2}] THEN {i}") for i in range(10)) + " END"


@plan("b03_stratified_by_target_bins", "B03,P09", f"""
WITH e AS (SELECT quantile_cont(o_totalprice, [{', '.join(str(i / 10) for i in range(11))}]) AS q FROM orders),
b AS (SELECT o_orderkey, {_decile_case('o_totalprice')} AS tbin FROM orders, e)
SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY tbin ORDER BY {_h('o_orderkey')}, o_orderkey)
  <= floor(count(*) OVER (PARTITION BY tbin) * 0.2) THEN 'test' ELSE 'train' END AS split FROM b""")
def b03(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    binned, _ = B.quantile_bins(o, "o_totalprice", 10, as_index=True, out="tbin")
    return S.stratified_split(binned, "o_orderkey", "tbin", 0.2).select("o_orderkey", "split")


@plan("b04_capped_per_class", "B04", f"""
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_h('event_id')}, event_id)
  AS rn FROM events) WHERE rn <= 100""")
def b04(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return S.capped_per_class(ev, "event_id", "event_type", 100).select("event_id", "event_type")


@plan("b05_fixed_size_sample", "B05", f"""
SELECT o_orderkey FROM orders ORDER BY {_h('o_orderkey')}, o_orderkey LIMIT 100""")
def b05(spark, sf_dir):
    return S.fixed_size_sample(Tables(spark, sf_dir).orders, "o_orderkey", 100).select("o_orderkey")


@plan("b06_kfold", "B06", f"SELECT o_orderkey, CAST({_h('o_orderkey')} % 5 AS INTEGER) AS fold FROM orders")
def b06(spark, sf_dir):
    return S.kfold(Tables(spark, sf_dir).orders, "o_orderkey", 5).select("o_orderkey", "fold")


@plan("b07_stratified_kfold", "B07", f"""
SELECT doc_id, CAST(ntile(5) OVER (PARTITION BY quality ORDER BY {_h('doc_id')}, doc_id) - 1 AS INTEGER) AS fold
FROM labels WHERE quality IS NOT NULL""")
def b07(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    return S.stratified_kfold(lab, "doc_id", "quality", 5).select("doc_id", "fold")


FRACS = [0.1, 0.25, 0.5, 1.0]


@plan("b08_nested_fractions", "B08", f"""
WITH p AS (SELECT row_number() OVER (ORDER BY {_h('o_orderkey')}, o_orderkey) AS pos, count(*) OVER () AS n FROM orders),
f(fraction) AS (VALUES {', '.join(f'({x}::DOUBLE)' for x in FRACS)})
SELECT fraction, CAST(count_if(pos <= floor(fraction * n)) AS BIGINT) AS n_rows FROM f CROSS JOIN p GROUP BY fraction""")
def b08(spark, sf_dir):
    return S.nested_fractions(Tables(spark, sf_dir).orders, "o_orderkey", FRACS)


SPLITS = ["train", "val", "test"]


@plan("g27_split_class_shares", "G27,B02", f"""
WITH s AS (SELECT quality, CASE
    WHEN row_number() OVER (PARTITION BY quality ORDER BY {_h('doc_id')}, doc_id) <= floor(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'test'
    WHEN row_number() OVER (PARTITION BY quality ORDER BY {_h('doc_id')}, doc_id) <= floor(count(*) OVER (PARTITION BY quality) * 0.2)
         + floor(count(*) OVER (PARTITION BY quality) * 0.1) THEN 'val' ELSE 'train' END AS split
  FROM labels WHERE quality IS NOT NULL),
c AS (SELECT quality, count_if(split = 'train') AS train, count_if(split = 'val') AS val, count_if(split = 'test') AS test
      FROM s GROUP BY 1)
SELECT quality, CAST(train AS BIGINT) AS train, CAST(val AS BIGINT) AS val, CAST(test AS BIGINT) AS test,
  CAST(train + val + test AS BIGINT) AS original,
  round((train + val + test) / sum(train + val + test) OVER (), 9) AS original_share,
  round(train / sum(train) OVER (), 9) AS train_share, round(val / sum(val) OVER (), 9) AS val_share,
  round(test / sum(test) OVER (), 9) AS test_share,
  round((train / sum(train) OVER () - (train + val + test) / sum(train + val + test) OVER ()) * 100, 9) + 0.0 AS train_delta_pts,
  round((val / sum(val) OVER () - (train + val + test) / sum(train + val + test) OVER ()) * 100, 9) + 0.0 AS val_delta_pts,
  round((test / sum(test) OVER () - (train + val + test) / sum(train + val + test) OVER ()) * 100, 9) + 0.0 AS test_delta_pts
FROM c""")
def g27(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    split = S.stratified_three_way(lab, "doc_id", "quality", 0.1, 0.2)
    out = split_class_shares(split, "quality", "split", SPLITS)
    return round_all(out, 9)
