"""Streaming monitoring (R01-R04) with Structured Streaming.

Sources are file directories (new files = new data), sinks are Parquet
directories with checkpoints, triggers are ``availableNow`` (process what is
there, then stop); nothing opens a port. Every streaming aggregation has a
batch twin over the same static data so results can be checked.
Zone-less event times are taken as UTC wall clock (session-independent).
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@contextmanager
def state_partitions(spark: SparkSession):
    """Start a stateful stream with ``tabkit.stream.statePartitions`` state
    partitions, or ``spark.sql.shuffle.partitions`` where that is unset. The
    number is fixed in the stream's (fresh) checkpoint at start; the session
    value is restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("tabkit.stream.statePartitions", old))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def utc_instant(ts: str | Column, spark: SparkSession) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP (watermarks need it)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    tz = spark.conf.get("spark.sql.session.timeZone")
    # UTC wall clock -> the same instant's wall clock in the session zone ->
    # TIMESTAMP (the cast reads wall clocks in the session zone)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c.cast("timestamp_ntz")).cast("timestamp")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stage_files(df: DataFrame, ts: str, out_dir: str, cut: str, late_from: str | None = None,
                late_until: str | None = None) -> Iterator[str]:
    """Write ``df`` as two arrivals: rows before ``cut``, then rows from ``cut`` on
    plus (optionally) a late copy of rows in ``[late_from, late_until)``. Yields
    each folder once it is there, so that a stream can run in between."""
    first = os.path.join(out_dir, "part-0")
    second = os.path.join(out_dir, "part-1")
    df.where(F.col(ts) < F.to_timestamp_ntz(F.lit(cut))).write.mode("overwrite").parquet(first)
    yield first
    rest = df.where(F.col(ts) >= F.to_timestamp_ntz(F.lit(cut)))
    if late_from is not None:
        late = df.where((F.col(ts) >= F.to_timestamp_ntz(F.lit(late_from))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(late_until))))
        rest = rest.unionByName(late)
    rest.write.mode("overwrite").parquet(second)
    yield second


def window_metrics(df: DataFrame, ts_col: str, truth: Column, pred: Column, size: str,
                   slide: str | None = None) -> DataFrame:
    """R01/R02 aggregation (shared by the stream and its batch twin):
    per event-time window n, RMSE, MAE and mean truth."""
    w = F.window(ts_col, size, slide) if slide else F.window(ts_col, size)
    e = truth - pred
    return (df.groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                 F.avg(truth).alias("mean_truth"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), "n", "rmse", "mae", "mean_truth"))


#: Event time of the closing row: after any event, so that every window before it ends.
CLOSING_TIME = "9999-01-01"


class BatchTimes:
    """Latest event time of every micro-batch, in a table beside the stream's
    checkpoint: what is late does not depend on a driver's memory, and a batch
    that is run again replaces its own row."""

    def __init__(self, spark: SparkSession, path: str, ts: str, watermark: str):
        self.spark, self.path, self.ts, self.watermark = spark, path, ts, watermark

    def _table(self) -> DataFrame:
        return self.spark.read.schema("batch_id long, latest timestamp_ntz, late_rows long").parquet(self.path)

    def record(self, rows: DataFrame, batch_id: int) -> int:
        """Rows of the batch that lie behind the watermark of the batches before it."""
        known = None
        try:
            known = self._table().where(F.col("batch_id") < batch_id).agg(F.max("latest").alias("m")).first()["m"]
        except AnalysisException:
            pass  # the first batch: no table yet
        behind = F.lit(False) if known is None else F.col(self.ts) < F.lit(known).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.watermark}")
        st = rows.where(F.col(self.ts) < F.to_timestamp_ntz(F.lit(CLOSING_TIME))).agg(
            F.max(self.ts).alias("latest"), F.count_if(behind).alias("late_rows")).first()
        row = self.spark.createDataFrame([(st["latest"], st["late_rows"])], "latest timestamp_ntz, late_rows long")
        row.coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, f"batch_id={batch_id}"))
        return st["late_rows"]

    def late_rows(self) -> int:
        return int(self._table().agg(F.sum("late_rows").alias("n")).first()["n"] or 0)


class WindowMetricsStream:
    """R01/R02 over arrival folders ``source/*``: ``run`` takes what has arrived
    since the last run, ``close`` ends every window, ``results`` reads the sink.

    All state (aggregation state, offsets, sink, late rows) lives under ``root`` in
    the shared folder, so a new object on the same root goes on where the last one
    stopped. Late rows are those behind the watermark of earlier batches; windows
    that ended before it are final, as in any watermarked aggregation."""

    def __init__(self, spark: SparkSession, source: str, root: str, schema, ts: str, truth: Column, pred: Column, size: str,
                 slide: str | None = None, watermark: str = "1 day"):
        self.spark, self.source, self.root, self.schema, self.ts = spark, source, root, schema, ts
        self.truth, self.pred, self.size, self.slide, self.watermark = truth, pred, size, slide, watermark
        self.times = BatchTimes(spark, os.path.join(root, "late"), ts, watermark)

    def _read(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(os.path.join(self.source, "*"))

    def _finish(self, writer, name: str) -> None:
        with state_partitions(self.spark):
            query = writer.option("checkpointLocation", os.path.join(self.root, f"ck-{name}")).trigger(availableNow=True).start()
        query.awaitTermination()

    def run(self) -> None:
        rows = self._read().withColumn("_et", utc_instant(self.ts, self.spark)).withWatermark("_et", self.watermark)
        agg = window_metrics(rows, "_et", self.truth, self.pred, self.size, self.slide)
        self._finish(agg.writeStream.outputMode("append").format("parquet").option("path", os.path.join(self.root, "out")), "windows")
        self._finish(self._read().select(self.ts).writeStream.foreachBatch(lambda df, i: self.times.record(df, i) and None), "late")

    def close(self) -> None:
        """One row at ``CLOSING_TIME`` moves the watermark past every window; its own
        window stays in the state. Rows that arrive afterwards are late."""
        last = self.spark.range(1).select(*[
            (F.to_timestamp_ntz(F.lit(CLOSING_TIME)) if f.name == self.ts else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema])
        last.write.mode("overwrite").parquet(os.path.join(self.source, "closing"))
        self.run()

    def results(self) -> DataFrame:
        return self.spark.read.schema("window_start long, n long, rmse double, mae double, mean_truth double").parquet(
            os.path.join(self.root, "out"))


def batch_window_metrics(df: DataFrame, ts: str, truth: Column, pred: Column, size: str,
                         slide: str | None = None) -> DataFrame:
    """Batch twin of R01/R02 over a static DataFrame."""
    spark = df.sparkSession
    return window_metrics(df.withColumn("_et", utc_instant(ts, spark)), "_et", truth, pred, size, slide)


def run_quality_stream(spark: SparkSession, source: str, schema, suite: Sequence[dict], ts: str,
                       watermark: str = "1 day", root: str | None = None) -> DataFrame:
    """``foreachBatch`` runs the S10 suite on every micro-batch of the arrival
    folders ``source/*`` and writes the report under its batch id (a batch that is
    run again replaces it), with the rows behind the watermark of earlier batches.
    On the same ``root`` a later call goes on with what has arrived since."""
    from ..operators.quality import run_suite
    root = root or scratch_dir(spark, "quality")
    out, ck = os.path.join(root, "report"), os.path.join(root, "ck")
    times = BatchTimes(spark, os.path.join(root, "late"), ts, watermark)

    def per_batch(rows: DataFrame, batch_id: int) -> None:
        late = times.record(rows, batch_id)
        report = run_suite(rows, suite).withColumn("late_rows", F.lit(late).cast("long"))
        report.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    stream = spark.readStream.schema(schema).parquet(os.path.join(source, "*"))
    stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))


def run_scoring_stream(spark: SparkSession, src_dir: str, schema, featurize, model, limit: float,
                       key: str) -> DataFrame:
    """Stateless features -> fitted ``PipelineModel.transform`` -> confident
    label (predicted class when its probability >= ``limit``, else null)."""
    from pyspark.ml.functions import vector_to_array
    root = scratch_dir(spark, "scoring")
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    stream = spark.readStream.schema(schema).parquet(src_dir)
    scored = model.transform(featurize(stream))
    probs = vector_to_array("probability")
    res = scored.select(key, F.col("prediction").cast("int").alias("prediction"),
                        F.array_max(probs).alias("confidence"))
    res = res.withColumn("label", F.when(F.col("confidence") >= F.lit(limit), F.col("prediction")))
    q = (res.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
