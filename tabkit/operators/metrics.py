"""Evaluation metrics as aggregates.

Everything is a grouped aggregate over (truth, prediction/score) rows; curves
are built from per-bucket or per-distinct-score counts, never by repeating
rows per threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import scalars
from .order import prefix_sum


def regression_metrics(df: DataFrame, y: str, p: str, group_cols: Sequence[str] = (),
                       as_percent: bool = True) -> DataFrame:
    """N, RMSE, MAE, R^2, MAPE (x100 when ``as_percent``, rule M20)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    scale = 100.0 if as_percent else 1.0
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(F.col(y)) * F.count(F.lit(1)))).alias("r2"),
            (F.avg(F.abs(F.try_divide(e, F.col(y)))) * F.lit(scale)).alias("mape")]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def confusion_matrix(df: DataFrame, truth: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group..., truth, pred, n, rate)`` with rates normalised per true class."""
    g = list(group_cols)
    cells = (df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
             .groupBy(*g, truth, pred).agg(F.count(F.lit(1)).alias("n")))
    rows = cells.groupBy(*g, truth).agg(F.sum("n").alias("_row"))
    return cells.join(rows, g + [truth]).withColumn("rate", F.col("n") / F.col("_row")).drop("_row")


def classification_report(df: DataFrame, truth: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per class precision, recall, F1, support over the classes present in
    ``truth`` (zero_division = 0; rule M21), plus rows ``accuracy``,
    ``macro avg`` and ``weighted avg`` (label column as text)."""
    g = list(group_cols)
    base = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull()) \
        .select(*g, F.col(truth).cast("string").alias("t"), F.col(pred).cast("string").alias("p"))
    sup = base.groupBy(*g, "t").agg(F.count(F.lit(1)).alias("support"),
                                    F.count_if(F.col("t") == F.col("p")).alias("tp"))
    predn = base.groupBy(*g, "p").agg(F.count(F.lit(1)).alias("n_pred")).withColumnRenamed("p", "t")
    per = sup.join(predn, g + ["t"], "left").fillna(0, subset=["n_pred"])
    per = (per.withColumn("precision", F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0)))
           .withColumn("recall", F.col("tp") / F.col("support")))
    per = per.withColumn("f1", F.when((F.col("precision") + F.col("recall")) > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    tot = per.groupBy(*g).agg(
        F.sum("support").alias("_n"), F.sum("tp").alias("_tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    per_rows = per.select(*g, F.col("t").alias("label"), "precision", "recall", "f1", F.col("support").cast("bigint"))
    acc = tot.select(*g, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("_tp") / F.col("_n")).alias("f1"),
                     F.col("_n").cast("bigint").alias("support"))
    mac = tot.select(*g, F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("_n").cast("bigint").alias("support"))
    wei = tot.select(*g, F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("_n").cast("bigint").alias("support"))
    return per_rows.unionByName(acc).unionByName(mac).unionByName(wei)


def grid_bucket(score: Column, steps: int = 100) -> Column:
    """Number of grid thresholds ``j/steps`` (j = 1..steps-1) strictly below ``score``."""
    b0 = F.ceil(score * F.lit(steps)).cast("int") - F.lit(1)
    t_b = b0.cast("double") / F.lit(float(steps))
    adj = F.when(score <= t_b, b0 - F.lit(1)).otherwise(b0)
    t_next = (adj + F.lit(1)).cast("double") / F.lit(float(steps))
    adj = F.when(score > t_next, adj + F.lit(1)).otherwise(adj)
    return F.greatest(F.lit(0), F.least(F.lit(steps - 1), adj))


def threshold_table(df: DataFrame, truth: str, score: str, steps: int = 100) -> DataFrame:
    """For thresholds ``j/steps`` (j = 1..steps-1), decision ``score > t``:
    tp, fp, fn, tn, precision, recall and false-positive/negative shares.
    Rows are counted once per grid bucket; the per-threshold counts are
    suffix sums over the <= ``steps`` bucket rows."""
    b = (df.where(F.col(truth).isNotNull() & F.col(score).isNotNull())
         .select(grid_bucket(F.col(score).cast("double"), steps).alias("bucket"),
                 F.col(truth).cast("int").alias("y"))
         .groupBy("bucket").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")))
    grid = df.sparkSession.range(1, steps).select(F.col("id").cast("int").alias("j"))
    tot = scalars(b.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    P, N = int(tot["P"] or 0), int(tot["N"] or 0)
    # bucket >= j  <=>  score > j/steps; the table has at most ``steps`` rows
    sfx = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = b.select("bucket", F.sum("pos").over(sfx).alias("tp"), F.sum("neg").over(sfx).alias("fp"))
    j = F.broadcast(grid).join(cum, F.col("bucket") == F.col("j"), "left")
    # buckets with no rows: carry the next non-empty bucket's suffix sums
    w = Window.orderBy(F.col("j").desc()).rowsBetween(Window.unboundedPreceding, 0)
    j = j.select("j", F.coalesce(F.last("tp", ignorenulls=True).over(w), F.lit(0)).alias("tp"),
                 F.coalesce(F.last("fp", ignorenulls=True).over(w), F.lit(0)).alias("fp"))
    return (j.select((F.col("j") / F.lit(float(steps))).alias("threshold"), F.col("tp").cast("bigint").alias("tp"),
                     F.col("fp").cast("bigint").alias("fp"))
            .withColumn("fn", F.lit(P) - F.col("tp")).withColumn("tn", F.lit(N) - F.col("fp"))
            .withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")))
            .withColumn("recall", F.try_divide(F.col("tp"), F.lit(P)))
            .withColumn("fp_share", F.try_divide(F.col("fp"), F.lit(P + N)))
            .withColumn("fn_share", F.try_divide(F.col("fn"), F.lit(P + N))))


def roc_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """ROC/PR points at every distinct score (descending), from prefix
    sums over the distinct-score table: ``(score, tp, fp, tpr, fpr, precision)``."""
    d = (df.where(F.col(truth).isNotNull() & F.col(score).isNotNull())
         .groupBy(F.col(score).cast("double").alias("score"))
         .agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg")))
    tot = scalars(d.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    P, N = float(tot["P"] or 0), float(tot["N"] or 0)
    c = prefix_sum(d, [F.col("score").desc()], ["pos", "neg"], out=["tp", "fp"])
    return (c.withColumn("tpr", F.col("tp") / F.lit(P)).withColumn("fpr", F.col("fp") / F.lit(N))
            .withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp"))))


def auc_scores(df: DataFrame, truth: str, score: str) -> DataFrame:
    """ROC AUC (trapezoid, ties as one step) and average precision, one row."""
    pts = roc_points(df, truth, score)
    tot = pts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = (lambda r: (float(r["P"] or 0), float(r["N"] or 0)))(scalars(tot))
    roc = F.sum((F.col("neg") / F.lit(N)) * (F.lit(2.0) * F.col("tp") - F.col("pos")) / F.lit(2.0 * P))
    ap = F.sum((F.col("pos") / F.lit(P)) * F.col("precision"))
    return pts.agg(roc.alias("roc_auc"), ap.alias("average_precision"))


def comparison_table(long: DataFrame, model: str, metric: str, value: str) -> DataFrame:
    """Long ``(model, metric, value)`` -> one row per model, metrics as
    columns; columns that are null for every model are dropped."""
    metrics = sorted(r[0] for r in long.select(metric).distinct().collect())
    wide = long.groupBy(model).pivot(metric, metrics).agg(F.first(value))
    nn = scalars(wide.agg(*[F.count(F.col(f"`{m}`")).alias(m) for m in metrics]))
    keep = [m for m in metrics if nn[m]]
    return wide.select(model, *[F.col(f"`{m}`") for m in keep])
