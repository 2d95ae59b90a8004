"""Schema checks."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPE_MAP = {
    "int64": T.LongType(), "int": T.IntegerType(), "float64": T.DoubleType(),
    "double": T.DoubleType(), "string": T.StringType(), "str": T.StringType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "datetime": T.TimestampType(), "timestamp": T.TimestampType(),
}


class SchemaError(ValueError):
    pass


def validate_schema(df: DataFrame, spec: dict[str, dict], strict: bool = True) -> DataFrame:
    """One row per spec column ``(column, present, nullable, null_count, ok)``.

    Missing columns and nulls in non-nullable columns are errors (raised when
    ``strict``); extra columns only warn. Null counts come from one ``agg``.
    """
    present = [c for c in spec if c in df.columns]
    missing = [c for c in spec if c not in df.columns]
    extra = [c for c in df.columns if c not in spec]
    if extra:
        warnings.warn(f"extra columns not in spec: {extra}")
    if missing and strict:
        raise SchemaError(f"missing columns: {missing}")
    spark = df.sparkSession
    if present:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
        long = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("null_count"))
            for c in present])).alias("s")).select("s.*")
    else:
        long = spark.createDataFrame([], "column string, null_count bigint")
    spec_rows = [(c, c in df.columns, bool(spec[c].get("nullable", True))) for c in spec]
    spec_df = spark.createDataFrame(spec_rows, "column string, present boolean, nullable boolean")
    out = (spec_df.join(F.broadcast(long), "column", "left")
           .withColumn("ok", F.col("present") & (F.col("nullable") | (F.coalesce("null_count", F.lit(0)) == 0))))
    return out


def assert_schema(df: DataFrame, spec: dict[str, dict]) -> None:
    bad = validate_schema(df, spec, strict=True).filter(~F.col("ok")).collect()
    if bad:
        raise SchemaError(f"schema check failed: {[r['column'] for r in bad]}")


def enforce_dtypes(df: DataFrame, spec: dict[str, str], timestamp_format: str | None = None) -> DataFrame:
    """Cast columns to the spec types; timestamps are lenient (bad -> null)."""
    cols = []
    for f in df.schema.fields:
        want = spec.get(f.name)
        c = F.col(f.name)
        if want is None:
            cols.append(c)
            continue
        dtype = _TYPE_MAP.get(want, None)
        if isinstance(dtype, T.TimestampType):
            src = c.cast("string")
            expr = F.try_to_timestamp(src, F.lit(timestamp_format)) if timestamp_format else F.try_to_timestamp(src)
            cols.append(expr.alias(f.name))
        elif isinstance(dtype, T.BooleanType):
            cols.append(c.try_cast("boolean").alias(f.name))
        elif dtype is not None:
            cols.append(c.try_cast(dtype).alias(f.name))
        else:
            cols.append(c.try_cast(want).alias(f.name))
    return df.select(*cols)


def basic_info(df: DataFrame, target: str | None = None, cap: float | None = None) -> DataFrame:
    """One-row summary ``(n_rows, n_columns, n_numeric, capped_count, capped_share)``.

    Everything in one aggregate; dtypes come from the schema (no job).
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if target is not None and cap is not None:
        aggs.append(F.count_if(F.col(target) >= F.lit(cap)).alias("capped_count"))
    out = df.agg(*aggs).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint")) \
        .withColumn("n_numeric", F.lit(len(numeric)).cast("bigint"))
    if target is not None and cap is not None:
        out = out.withColumn("capped_share", F.try_divide(F.col("capped_count"), F.col("n_rows")))
    return out


def dtypes_table(df: DataFrame) -> DataFrame:
    """Column names and Spark types as a small table (no job over the data)."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields],
        "column string, dtype string, nullable boolean")
