"""Data-quality suite (S10) and dataset quality report (S11), run-table.

All checks of a suite are compiled into ONE aggregate over the data (plus a
schema comparison that needs no job), then unpivoted to one row per check.
Check types are registered by name so users can add their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count


class QualityError(RuntimeError):
    pass


# name -> builder(df, spec) -> (observed aggregate Column | python value, success Column builder)
CHECKS: dict[str, Callable] = {}


def check(name: str):
    def deco(fn):
        CHECKS[name] = fn
        return fn
    return deco


@check("row_count_between")
def _row_count(df, spec):
    obs = F.count(F.lit(1)).cast("double")
    lo, hi = spec.get("min"), spec.get("max")
    ok = lambda o: (F.lit(True) if lo is None else o >= F.lit(lo)) & (F.lit(True) if hi is None else o <= F.lit(hi))
    return obs, ok


@check("columns_match_set")
def _columns(df, spec):
    want = set(spec["columns"])
    have = set(df.columns)
    diff = len(want ^ have) if spec.get("exact", True) else len(want - have)
    return F.lit(float(diff)), lambda o: o == F.lit(0.0)


@check("not_null")
def _not_null(df, spec):
    c = spec["column"]
    obs = F.avg(F.col(c).isNotNull().cast("double"))
    mostly = float(spec.get("mostly", 1.0))
    return obs, lambda o: o >= F.lit(mostly)


@check("values_between")
def _between(df, spec):
    c = F.col(spec["column"])
    lo, hi = spec.get("min"), spec.get("max")
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    obs = F.count_if(c.isNotNull() & bad).cast("double")  # nulls ignored
    mostly = spec.get("mostly")
    if mostly is None:
        return obs, lambda o: o == F.lit(0.0)
    nn = F.count(c)
    return (F.lit(1.0) - F.try_divide(obs, nn)), lambda o: o >= F.lit(float(mostly))


@check("mean_between")
def _mean(df, spec):
    obs = F.avg(F.col(spec["column"]).cast("double"))
    lo, hi = spec.get("min"), spec.get("max")
    return obs, lambda o: (F.lit(True) if lo is None else o >= F.lit(lo)) & (F.lit(True) if hi is None else o <= F.lit(hi))


@check("values_in_set")
def _in_set(df, spec):
    c = F.col(spec["column"])
    obs = F.count_if(c.isNotNull() & ~c.isin(*spec["values"])).cast("double")
    return obs, lambda o: o == F.lit(0.0)


def run_suite(df: DataFrame, suite: Sequence[dict], fail_on_error: bool = False) -> DataFrame:
    """``suite`` = list of ``{"type": ..., "column": ..., <kwargs>}``.
    Returns ``(check_id, type, column, kwargs, observed, success)``; with
    ``fail_on_error`` raises ``QualityError`` after computing the report."""
    obs_cols, ok_fns = [], []
    for i, spec in enumerate(suite):
        if spec["type"] not in CHECKS:
            raise ValueError(f"unknown check type: {spec['type']}")
        obs, ok = CHECKS[spec["type"]](df, spec)
        obs_cols.append(obs.alias(f"c{i}"))
        ok_fns.append(ok)
    one = df.agg(*obs_cols)
    rows = []
    for i, spec in enumerate(suite):
        kwargs = {k: v for k, v in spec.items() if k not in ("type", "column")}
        rows.append(F.struct(F.lit(i).alias("check_id"), F.lit(spec["type"]).alias("type"),
                             F.lit(spec.get("column")).cast("string").alias("column"),
                             F.lit(json.dumps(kwargs, sort_keys=True)).alias("kwargs"),
                             F.col(f"c{i}").cast("double").alias("observed"),
                             F.coalesce(ok_fns[i](F.col(f"c{i}").cast("double")), F.lit(False)).alias("success")))
    report = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if fail_on_error:
        failed = report.where(~F.col("success")).collect()
        if failed:
            raise QualityError(f"{len(failed)} quality checks failed: {[r['type'] for r in failed]}")
    return report


def quality_report(df: DataFrame, key: str, text: str, label: str, labelled: str | None = None,
                   noise_flags: Sequence[str] = ()) -> DataFrame:
    """One row: totals, label coverage, noise flag counts, null counts,
    duplicate ids, word-count stats and distinct-text share (one aggregate)."""
    wc = word_count(text)
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count(F.col(label)).alias("n_labelled"),
            (F.count(F.col(label)) / F.count(F.lit(1))).alias("label_coverage"),
            (F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("duplicate_ids"),
            F.count_if(F.col(text).isNull()).alias("null_text"),
            F.count_if(F.col(label).isNull()).alias("null_label"),
            F.avg(wc).alias("words_mean"), F.stddev_samp(wc).alias("words_std"),
            F.min(wc).alias("words_min"), F.max(wc).alias("words_max"),
            # distinct texts via a SHA-256 digest: 32 bytes shuffled per row, not the text
            (F.count_distinct(F.sha2(F.col(text), 256)) / F.count(F.lit(1))).alias("distinct_text_share")]
    aggs += [F.count_if(F.col(f).cast("boolean")).alias(f"n_{f}") for f in noise_flags]
    return df.agg(*aggs)


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """S11 companion: class shares of the labelled rows (one ``groupBy``)."""
    c = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n")).first()[0]
    return c.withColumn("share", F.col("n") / F.lit(float(tot)))


# ---------------------------------------------------------------- S12 run table

RUN_SCHEMA = "run_id long, version long, stage string, model string, key string, value double"


def append_runs(runs: DataFrame, path: str) -> None:
    """Append ``(run_id, version, stage, model, key, value)`` rows."""
    runs.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in RUN_SCHEMA.split(", ")]) \
        .write.mode("append").parquet(path)


def latest_and_best(spark, path: str, metric: str, lower_is_better: bool = True) -> DataFrame:
    """Per model the latest version's metric and the best run's metric."""
    r = spark.read.schema(RUN_SCHEMA).parquet(path).where(F.col("key") == metric)
    best = F.min_by if lower_is_better else F.max_by
    bestv = F.min("value") if lower_is_better else F.max("value")
    return r.groupBy("model").agg(F.max("version").alias("latest_version"),
                                  F.max_by("value", "version").alias("latest_value"),
                                  best("run_id", "value").alias("best_run"), bestv.alias("best_value"))
