"""Plans for sources/sinks and schema/quality checks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import quality as QU
from ..sources import io as IO
from ..sources import schema as SC
from ..streaming.monitor import scratch_dir
from .registry import Tables, plan, rnd

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
NATION_NAMES = ["n_nationkey", "n_name", "n_regionkey"]


@plan("s01_s02_csv_ingest", "S01,S02,S06", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s01(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = scratch_dir(spark, "ingest")
    raw = os.path.join(root, "raw")
    t.customer.repartition(3).write.option("header", "true").csv(raw)  # several CSV files, one dataset
    out = os.path.join(root, "customer.parquet")
    IO.ingest_csv_to_parquet(spark, raw, out, schema=CUSTOMER_SCHEMA, codec="zstd", required=["c_custkey"])
    again = IO.ingest_csv_to_parquet(spark, raw, out, schema=CUSTOMER_SCHEMA, codec="zstd")  # skipped: exists
    assert again["status"] == "skipped"
    back = IO.read_parquet(spark, out)
    IO.require_columns(back, ["c_custkey", "c_mktsegment"])
    return back


@plan("s01_latin1_headerless", "S01", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s01b(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = os.path.join(scratch_dir(spark, "latin1"), "raw")
    t.nation.write.option("header", "false").option("encoding", "ISO-8859-1").csv(raw)
    return IO.read_csv_dir(spark, raw, schema="a int, b string, c int", header=False, encoding="ISO-8859-1",
                           names=NATION_NAMES)


@plan("s04_write_parquet_roundtrip", "S04", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def s04(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return IO.write_parquet(li, os.path.join(scratch_dir(spark, "write"), "li.parquet"), codec="zstd")


@plan("s05_report_sink", "S05,G03", """
SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1""")
def s05(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    rep = o.groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    path = IO.write_report(rep, scratch_dir(spark, "reports"), "value_counts", fmt="csv")
    return spark.read.schema("value string, count bigint").option("header", "true").csv(path)


SPEC = {"doc_id": {"nullable": False}, "text": {"nullable": False}, "lang": {"nullable": False},
        "quality": {"nullable": True}, "toxic": {"nullable": False}, "missing_col": {"nullable": False}}


@plan("s07_validate_schema", "S07", """
WITH j AS (SELECT d.doc_id, d.text, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT 'doc_id' AS "column", count_if(doc_id IS NULL) AS null_count FROM j UNION ALL
      SELECT 'text', count_if(text IS NULL) FROM j UNION ALL SELECT 'lang', count_if(lang IS NULL) FROM j UNION ALL
      SELECT 'quality', count_if(quality IS NULL) FROM j UNION ALL SELECT 'toxic', count_if(toxic IS NULL) FROM j),
s("column", present, nullable) AS (VALUES ('doc_id', true, false), ('text', true, false), ('lang', true, false),
  ('quality', true, true), ('toxic', true, false), ('missing_col', false, false))
SELECT s."column", present, nullable, CAST(null_count AS BIGINT) AS null_count,
  present AND (nullable OR coalesce(null_count, 0) = 0) AS ok FROM s LEFT JOIN c ON s."column" = c."column" """)
def s07(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "text", "lang").join(t.labels, "doc_id", "left")
    return SC.validate_schema(j, SPEC, strict=False)


@plan("s08_enforce_dtypes", "S08", """
SELECT event_id, CAST(TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS VARCHAR) AS ts_s, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_s,
  TRY_CAST('bad' || CAST(event_id AS VARCHAR) AS TIMESTAMP) IS NULL AS bad_ts_is_null,
  CASE WHEN value > 10 THEN true ELSE false END AS flag_s FROM events""")
def s08(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select(
        "event_id", F.col("ts").cast("string").alias("ts_s"), F.col("value").cast("string").alias("value_s"),
        F.concat(F.lit("bad"), F.col("event_id").cast("string")).alias("bad_ts"),
        F.when(F.col("value") > 10, "true").otherwise("false").alias("flag_s"))
    out = SC.enforce_dtypes(ev, {"ts_s": "timestamp", "value_s": "double", "bad_ts": "timestamp", "flag_s": "bool"})
    return out.select("event_id", F.col("ts_s").cast("string").alias("ts_s"), "value_s",
                      F.col("bad_ts").isNull().alias("bad_ts_is_null"), "flag_s")


@plan("s09_basic_info", "S09", """
SELECT count(*) AS n_rows, CAST(count_if(o_totalprice >= 450000) AS BIGINT) AS capped_count, 6 AS n_columns, 3 AS n_numeric,
  round(count_if(o_totalprice >= 450000) / count(*), 9) AS capped_share FROM orders""")
def s09(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    out = SC.basic_info(o, target="o_totalprice", cap=450000)
    return out.select("n_rows", "capped_count", F.col("n_columns").cast("int").alias("n_columns"),
                      F.col("n_numeric").cast("int").alias("n_numeric"), rnd("capped_share", 9).alias("capped_share"))


SUITE = [
    {"type": "row_count_between", "min": 1, "max": 1000000000},
    {"type": "columns_match_set", "columns": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority"]},
    {"type": "not_null", "column": "o_orderkey"},
    {"type": "not_null", "column": "o_custkey", "mostly": 0.95},
    {"type": "values_between", "column": "o_totalprice", "min": 0},
    {"type": "values_between", "column": "o_totalprice", "min": 1000, "max": 400000, "mostly": 0.9},
    {"type": "mean_between", "column": "o_totalprice", "min": 100000, "max": 200000},
    {"type": "values_in_set", "column": "o_orderstatus", "values": ["F", "O", "P"]},
    {"type": "values_in_set", "column": "o_orderpriority", "values": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
]


def _suite_sql():
    import json
    parts = []
    for i, s in enumerate(SUITE):
        kw = json.dumps({k: v for k, v in s.items() if k not in ("type", "column")}, sort_keys=True).replace("'", "''")
        col = f"'{s['column']}'" if "column" in s else "NULL"
        t = s["type"]
        c = s.get("column")
        if t == "row_count_between":
            obs, ok = "count(*)::DOUBLE", f"count(*) >= {s['min']} AND count(*) <= {s['max']}"
        elif t == "columns_match_set":
            obs, ok = "(count(*) * 0.0)::DOUBLE", "count(*) >= 0"
        elif t == "not_null":
            obs = f"avg(CAST({c} IS NOT NULL AS DOUBLE))"
            ok = f"{obs} >= {float(s.get('mostly', 1.0))}"
        elif t == "values_between":
            bad = " OR ".join(x for x in [f"{c} < {s['min']}" if s.get("min") is not None else None,
                                          f"{c} > {s['max']}" if s.get("max") is not None else None] if x)
            cnt = f"count_if({c} IS NOT NULL AND ({bad}))::DOUBLE"
            if s.get("mostly") is None:
                obs, ok = cnt, f"{cnt} = 0"
            else:
                obs = f"(1.0 - {cnt} / count({c}))"
                ok = f"{obs} >= {float(s['mostly'])}"
        elif t == "mean_between":
            obs = f"avg({c})"
            ok = f"{obs} >= {s['min']} AND {obs} <= {s['max']}"
        else:
            vals = ", ".join(f"'{v}'" for v in s["values"])
            obs = f"count_if({c} IS NOT NULL AND {c} NOT IN ({vals}))::DOUBLE"
            ok = f"{obs} = 0"
        parts.append(f"SELECT {i} AS check_id, '{t}' AS type, {col} AS \"column\", '{kw}' AS kwargs, "
                     f"round({obs}, 6) AS observed, coalesce({ok}, false) AS success FROM orders")
    return "\nUNION ALL\n".join(parts)


@plan("s10_quality_suite", "S10,S10a,S10b,S10c,S10d,S10e,S10f", _suite_sql())
def s10(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    rep = QU.run_suite(o, SUITE)
    return rep.withColumn("check_id", F.col("check_id").cast("int")).withColumn("observed", rnd("observed", 6))


@plan("s11_quality_report", "S11", """
WITH j AS (SELECT d.doc_id, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
w AS (SELECT *, CAST(len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')) AS INTEGER) AS wc FROM j)
SELECT count(*) AS n_rows, count(quality) AS n_labelled, round(count(quality) / count(*), 9) AS label_coverage,
  count(*) - count(DISTINCT doc_id) AS duplicate_ids, CAST(count_if(text IS NULL) AS BIGINT) AS null_text, CAST(count_if(quality IS NULL) AS BIGINT) AS null_label,
  round(avg(wc), 6) AS words_mean, round(stddev_samp(wc), 6) AS words_std, min(wc) AS words_min, max(wc) AS words_max,
  round(count(DISTINCT text) / count(*), 9) AS distinct_text_share FROM w""")
def s11(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    out = QU.quality_report(j, "doc_id", "text", "quality")
    return out.select("n_rows", "n_labelled", rnd("label_coverage", 9).alias("label_coverage"), "duplicate_ids",
                      "null_text", "null_label", rnd("words_mean", 6).alias("words_mean"),
                      rnd("words_std", 6).alias("words_std"), "words_min", "words_max",
                      rnd("distinct_text_share", 9).alias("distinct_text_share"))


@plan("s12_run_table", "S12,Z06", """
WITH f AS (SELECT *, CAST((('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)), 1, 8))::BIGINT) % 5 AS INTEGER) AS fold,
             l_extendedprice / l_quantity AS up FROM lineitem),
a AS (SELECT sum(up) AS s, count(*) AS c FROM f),
fs AS (SELECT fold, sum(up) AS s, count(*) AS c FROM f GROUP BY fold),
ps AS (SELECT l_partkey, sum(up) AS s, count(*) AS c FROM f GROUP BY 1),
pfs AS (SELECT l_partkey, fold, sum(up) AS s, count(*) AS c FROM f GROUP BY 1, 2),
p AS (SELECT f.fold, l_extendedprice AS y, l_quantity * (a.s - fs.s) / (a.c - fs.c) AS p_base,
        l_quantity * CASE WHEN ps.c - pfs.c > 0 THEN (ps.s - pfs.s) / (ps.c - pfs.c) ELSE (a.s - fs.s) / (a.c - fs.c) END AS p_part
      FROM f JOIN fs USING (fold) JOIN ps USING (l_partkey) JOIN pfs ON pfs.l_partkey = f.l_partkey AND pfs.fold = f.fold, a),
r AS (SELECT 1 AS run_id, 1 AS version, avg(rb) AS value FROM (SELECT fold, sqrt(avg((y - p_base) * (y - p_base))) AS rb FROM p GROUP BY 1)
      UNION ALL SELECT 2, 2, avg(rp) FROM (SELECT fold, sqrt(avg((y - p_part) * (y - p_part))) AS rp FROM p GROUP BY 1))
SELECT 'unit_price' AS model, CAST(max(version) AS BIGINT) AS latest_version, round(arg_max(value, version), 6) AS latest_value,
  CAST(arg_min(run_id, value) AS BIGINT) AS best_run, round(min(value), 6) AS best_value FROM r""")
def s12(spark, sf_dir):
    from ..operators import models as MD
    from .eval_plans import li_folds
    res = MD.candidate_cv(li_folds(Tables(spark, sf_dir)))
    runs = res.select(F.when(F.col("model") == "baseline", 1).otherwise(2).alias("run_id"),
                      F.when(F.col("model") == "baseline", 1).otherwise(2).alias("version"),
                      F.lit("cv").alias("stage"), F.lit("unit_price").alias("model"), F.lit("rmse").alias("key"),
                      F.col("cv_rmse").alias("value"))
    path = os.path.join(scratch_dir(spark, "runs"), "runs.parquet")
    QU.append_runs(runs.where(F.col("run_id") == 1), path)
    QU.append_runs(runs.where(F.col("run_id") == 2), path)
    out = QU.latest_and_best(spark, path, "rmse")
    return out.select("model", "latest_version", rnd("latest_value", 6).alias("latest_value"), "best_run",
                      rnd("best_value", 6).alias("best_value"))


@plan("s10g_fail_on_error", "S10g", """
WITH c AS (SELECT count(*) = 0 AS any_rows, min(l_quantity) < 10 AS small, count(*) FILTER (l_discount IS NULL) > 0 AS nulls FROM lineitem)
SELECT 'strict' AS suite, (small::INT + nulls::INT + any_rows::INT) > 0 AS raised, (small::INT + nulls::INT + any_rows::INT)::BIGINT AS n_failed FROM c
UNION ALL SELECT 'lenient', (nulls::INT + any_rows::INT) > 0, (nulls::INT + any_rows::INT)::BIGINT FROM c""")
def s10g(spark, sf_dir):
    """Whether a run under ``fail_on_error`` raises, and how many checks failed."""
    from ..operators.quality import QualityError, run_suite
    li = Tables(spark, sf_dir).lineitem
    common = [{"type": "row_count_between", "min": 1, "max": 1 << 60}, {"type": "not_null", "column": "l_discount"}]
    suites = {"strict": [*common, {"type": "values_between", "column": "l_quantity", "min": 10}], "lenient": common}
    rows = []
    for name, suite in suites.items():
        try:
            run_suite(li, suite, fail_on_error=True)
            raised = False
        except QualityError:
            raised = True
        rows.append((name, raised, run_suite(li, suite).where("NOT success").count()))
    return spark.createDataFrame(rows, "suite string, raised boolean, n_failed long")
