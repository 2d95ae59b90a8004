"""Joins, lookups and set operations.

Broadcast hints are only placed on tables whose size is bounded by
construction (literal lookups, top-N lists); everything else is left to
Catalyst/AQE, which measures the real size at runtime before choosing a
broadcast, and splits skewed sort-merge partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pivot import top_categories


def left_join(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join; duplicate keys on the right multiply rows (as pandas merge)."""
    return df.join(other, on, "left")


def align_columns(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Row-aligned combination of two column sets sharing a key."""
    return df.join(other, key, "inner")


def lookup(df: DataFrame, column: str, mapping: Mapping, out: str, key_type: str = "string",
           value_type: str = "double") -> DataFrame:
    """Small dict lookup as a broadcast join (the dict is the size bound)."""
    spark = df.sparkSession
    lk = spark.createDataFrame(list(mapping.items()), f"{column} {key_type}, {out} {value_type}")
    return df.join(F.broadcast(lk), column, "left")


def align_distributions(a: DataFrame, b: DataFrame, key: str, a_name: str, b_name: str) -> DataFrame:
    """Full outer alignment of two ``(key, value)`` tables; missing -> 0."""
    ja = a.withColumnRenamed(a.columns[1], a_name)
    jb = b.withColumnRenamed(b.columns[1], b_name)
    j = ja.join(jb, key, "full")
    return j.select(key, F.coalesce(a_name, F.lit(0)).alias(a_name), F.coalesce(b_name, F.lit(0)).alias(b_name))


def keep_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose ``column`` is among the ``n`` most frequent values (semi join
    against a list of at most ``n`` rows, so the broadcast is bounded)."""
    return df.join(F.broadcast(top_categories(df, column, n)), column, "left_semi")


def rows_not_in(df: DataFrame, sample: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Anti join on a key."""
    return df.join(sample, key, "left_anti")


def expand_grid(df: DataFrame, name: str, values: Sequence[float]) -> DataFrame:
    """Each row of a small aggregate repeated for every grid value
    (``explode`` of a literal array; no data-sized cross product)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))


def union_labelled(parts: Sequence[tuple[str, DataFrame]], label_col: str = "source",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Union by name of same-schema tables with a constant label column."""
    out = None
    for label, df in parts:
        d = df.withColumn(label_col, F.lit(label))
        if columns:
            d = d.select(label_col, *columns)
        out = d if out is None else out.unionByName(d)
    return out


def minus_all(df: DataFrame, other: DataFrame) -> DataFrame:
    """U02 without a key: multiset difference."""
    return df.exceptAll(other)
