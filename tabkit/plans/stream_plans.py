"""Plans for streaming monitoring (R01-R04) and their batch twins."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..streaming import monitor as MO
from .registry import Tables, plan, round_all


def _type_means(ev):
    """Fitted model of the plans: mean value per event type (one row per type)."""
    rows = ev.groupBy("event_type").agg(F.avg("value").alias("m")).collect()
    if len(rows) > 10000:
        raise ValueError("too many event types for a literal map")
    return {r["event_type"]: float(r["m"]) for r in rows}


def _pred(means: dict):
    kv = []
    for k, v in sorted(means.items()):
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)[F.col("event_type")]


PRED_SQL = "(SELECT event_type, avg(value) AS m FROM events GROUP BY 1)"


R01_SQL = f"""
WITH e AS (SELECT ts, value, m FROM events JOIN {PRED_SQL} USING (event_type))
SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, count(*) AS n,
  round(sqrt(avg((value - m) * (value - m))), 6) AS rmse, round(avg(abs(value - m)), 6) AS mae,
  round(avg(value), 6) AS mean_truth FROM e GROUP BY 1"""

R02_SQL = f"""
WITH e AS (SELECT ts, value, m FROM events JOIN {PRED_SQL} USING (event_type)),
x AS (SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS ws, value, m FROM e CROSS JOIN range(0, 3) t(k))
SELECT CAST(epoch(ws) AS BIGINT) AS window_start, count(*) AS n, round(sqrt(avg((value - m) * (value - m))), 6) AS rmse,
  round(avg(abs(value - m)), 6) AS mae, round(avg(value), 6) AS mean_truth FROM x GROUP BY 1"""


@plan("r01_window_metrics_batch_twin", "R01,V01", R01_SQL)
def r01(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    out = MO.batch_window_metrics(ev, "ts", F.col("value"), _pred(_type_means(ev)), "1 day")
    return round_all(out, 6)


@plan("r02_sliding_metrics_batch_twin", "R02", R02_SQL)
def r02(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    out = MO.batch_window_metrics(ev, "ts", F.col("value"), _pred(_type_means(ev)), "3 days", "1 day")
    return round_all(out, 6)


LATE_FROM, LATE_UNTIL, CUT = "2024-01-02", "2024-01-03", "2024-01-16"


@plan("r01_r02_window_metrics_stream", "R01,R02", f"""
SELECT t.*, 'tumbling' AS kind, late_rows_dropped FROM ({R01_SQL}) t,
  (SELECT count(*) AS late_rows_dropped FROM events WHERE ts >= '{LATE_FROM}' AND ts < '{LATE_UNTIL}')
UNION ALL SELECT s.*, 'sliding', late_rows_dropped FROM ({R02_SQL}) s,
  (SELECT count(*) AS late_rows_dropped FROM events WHERE ts >= '{LATE_FROM}' AND ts < '{LATE_UNTIL}')""")
def r01s(spark, sf_dir):
    """Two arrivals, the second with a late copy of a day; a run after each, by an
    object of its own, and a closing step: the windows of the batch twin."""
    ev = Tables(spark, sf_dir).events
    root, pred = MO.scratch_dir(spark, "events"), _pred(_type_means(ev))
    source = os.path.join(root, "in")

    def streams():
        return [(kind, MO.WindowMetricsStream(spark, source, os.path.join(root, kind), ev.schema, "ts", F.col("value"), pred, *size))
                for kind, size in (("tumbling", ("1 day",)), ("sliding", ("3 days", "1 day")))]

    for _ in MO.stage_files(ev, "ts", source, cut=CUT, late_from=LATE_FROM, late_until=LATE_UNTIL):
        for _, s in streams():
            s.run()
    parts = []
    for kind, s in streams():
        s.close()
        parts.append(round_all(s.results(), 6).withColumn("kind", F.lit(kind))
                     .withColumn("late_rows_dropped", F.lit(s.times.late_rows()).cast("long")))
    return parts[0].unionByName(parts[1])


@plan("r03_quality_stream", "R03,S10", f"""
WITH b AS (SELECT 0 AS batch_id, value, event_type, event_id, 0 AS late FROM events WHERE ts < '{CUT}'
  UNION ALL SELECT 1, value, event_type, event_id, 0 FROM events WHERE ts >= '{CUT}'
  UNION ALL SELECT 1, value, event_type, event_id, 1 FROM events WHERE ts >= '{LATE_FROM}' AND ts < '{LATE_UNTIL}'),
s AS (SELECT batch_id, sum(late)::BIGINT AS late_rows, count(*) > 0 AS rows_ok, count(*) = count(event_id) AS ids_ok,
  min(value) >= 0 AS values_ok, bool_and(event_type IN ('click', 'view', 'purchase', 'signup', 'error')) AS types_ok FROM b GROUP BY 1)
SELECT batch_id::BIGINT AS batch_id, late_rows, unnest(['row_count_between', 'not_null', 'values_between', 'values_in_set']) AS "check",
  unnest([rows_ok, ids_ok, values_ok, types_ok]) AS success FROM s""")
def r03(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    suite = [{"type": "row_count_between", "min": 1, "max": 1000000000},
             {"type": "not_null", "column": "event_id"},
             {"type": "values_between", "column": "value", "min": 0},
             {"type": "values_in_set", "column": "event_type", "values": ["click", "view", "purchase", "signup", "error"]}]
    root = MO.scratch_dir(spark, "events_q")
    source = os.path.join(root, "in")
    for _ in MO.stage_files(ev, "ts", source, cut=CUT, late_from=LATE_FROM, late_until=LATE_UNTIL):
        report = MO.run_quality_stream(spark, source, ev.schema, suite, "ts", root=os.path.join(root, "state"))
    return report.select("batch_id", "late_rows", F.col("type").alias("check"), "success")


@plan("r04_scoring_stream", "R04,A03,A16,V-F09,V11")
def r04(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from ..functions.dates import time_features
    ev = Tables(spark, sf_dir).events

    def featurize(df):
        out = time_features(df, "ts", tz=None)
        return out.withColumn("label", (F.col("event_type") == "purchase").cast("double"))

    feats = ["value", "hour_sin", "hour_cos", "night_shift"]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            LogisticRegression(maxIter=30, regParam=0.01)])
    model = pipe.fit(featurize(ev))
    root = MO.scratch_dir(spark, "events_s")
    src = os.path.join(root, "in")
    for _ in MO.stage_files(ev, "ts", src, cut=CUT):
        pass
    return MO.run_scoring_stream(spark, os.path.join(src, "*"), ev.schema, featurize, model, limit=0.6, key="event_id")
