"""Sources and sinks.

All readers return lazy DataFrames; writers run one distributed write job.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class MissingInputError(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 nan_to_null: bool = False) -> DataFrame:
    """Read a Parquet dataset with a clear error when the path is missing.

    ``nan_to_null`` maps NaN to null in floating columns (rule M1) so that
    averages and sorts behave like the pandas original.
    """
    if not _exists(spark, path):
        raise MissingInputError(f"input not found: {path}")
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if nan_to_null:
        df = df.select(*[
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields])
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated test tables."""
    return read_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"))


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 header: bool = True, encoding: str = "UTF-8", names: list[str] | None = None,
                 timestamp_format: str | None = None, drop_first_column: bool = False,
                 sep: str = ",") -> DataFrame:
    """Read every CSV file of a directory (or one file) as one DataFrame.

    Variants of the reference: ISO-8859-1 files, headerless files with given
    names, parsed timestamps, and an ordinal index column to drop.
    """
    if not _exists(spark, path):
        raise MissingInputError(f"input not found: {path}")
    reader = (spark.read.option("header", str(header).lower())
              .option("encoding", encoding).option("sep", sep)
              .option("quote", '"').option("escape", '"'))
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    if names:
        df = df.toDF(*names)
    if drop_first_column:
        df = df.drop(df.columns[0])
    return df


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """Metadata-only check (no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def ingest_csv_to_parquet(spark: SparkSession, raw_dir: str, out: str,
                          schema: T.StructType | str | None = None, codec: str = "snappy",
                          required: list[str] | None = None, skip_if_exists: bool = True,
                          force: bool = False) -> dict:
    """All CSV files of a directory into one Parquet dataset.

    ``skip_if_exists`` keeps an existing output (write mode ``ignore``);
    ``force`` overwrites it. Returns a small summary dict (path, codec, status).
    """
    if codec not in {"snappy", "gzip", "zstd", "lz4", "none", "uncompressed", "brotli"}:
        raise ValueError(f"unsupported codec: {codec}")
    if _exists(spark, out) and skip_if_exists and not force:
        return {"path": out, "codec": codec, "status": "skipped"}
    df = read_csv_dir(spark, raw_dir, schema=schema)
    if required:
        require_columns(df, required)
    mode = "overwrite" if (force or not skip_if_exists) else "errorifexists"
    df.write.mode(mode).option("compression", codec).parquet(out)
    return {"path": out, "codec": codec, "status": "written"}


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", mode: str = "overwrite",
                  verify: bool = True, partition_by: list[str] | None = None) -> DataFrame:
    """Write and return the read-back dataset (schema checked)."""
    w = df.write.mode(mode).option("compression", codec)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    back = df.sparkSession.read.parquet(path)
    if verify and sorted(back.columns) != sorted(df.columns):
        raise ValueError("read-back columns differ from written columns")
    return back


def write_report(df: DataFrame, out_dir: str, name: str, fmt: str = "csv",
                 timestamped: bool = True) -> str:
    """Write one small result table (already aggregated) as CSV or JSON.

    ``coalesce(1)`` is only acceptable here because reports are small
    aggregates; data-sized outputs use ``write_parquet``.
    """
    stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S") if timestamped else ""
    path = os.path.join(out_dir, f"{name}_{stamp}" if stamp else name)
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unknown report format: {fmt}")
    return path
