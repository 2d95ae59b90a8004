"""Deterministic splits and samples (B01-B08, G27 input).

Random assignment is replaced by an md5 bucket of the row key (rule M23):
the same key always lands in the same split on any cluster size, re-runs
after executor loss are identical, and DuckDB can repeat it as an oracle.
Per-class positions come from the range-partitioned prefix sum, so a class
holding most rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import ntile_from_position, row_positions

TWO32 = float(2 ** 32)


def key_hash(key: str | Column) -> Column:
    """First 8 hex digits of md5(key as text) as an integer in [0, 2^32)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long")


def key_uniform(key: str | Column) -> Column:
    return key_hash(key) / F.lit(TWO32)


def random_split(df: DataFrame, key: str, fractions: Sequence[float], names: Sequence[str] = ("train", "val", "test"),
                 out: str = "split") -> DataFrame:
    """2- or 3-way split by md5 bucket of the key (fractions sum to 1)."""
    u = key_uniform(key)
    expr, acc = None, 0.0
    for frac, name in zip(fractions[:-1], names):
        acc += frac
        expr = F.when(u < F.lit(acc), F.lit(name)) if expr is None else expr.when(u < F.lit(acc), F.lit(name))
    last = names[len(fractions) - 1]
    return df.withColumn(out, expr.otherwise(F.lit(last)) if expr is not None else F.lit(last))


def _class_positions(df: DataFrame, key: str, label: str) -> DataFrame:
    base = df.where(F.col(label).isNotNull()).withColumn("_h", key_hash(key))
    pos = row_positions(base, ["_h", key], [label], out="_pos")
    sizes = base.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    # one row per class: small, but its size is not proven, so AQE decides the join
    return pos.join(sizes, label)


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float, out: str = "split",
                     names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Per class, the first ``floor(n_c * test_frac)`` rows in md5 order go to test."""
    p = _class_positions(df, key, label)
    cut = F.floor(F.col("_n") * F.lit(float(test_frac)))
    return (p.withColumn(out, F.when(F.col("_pos") <= cut, F.lit(names[1])).otherwise(F.lit(names[0])))
            .drop("_h", "_pos", "_n"))


def stratified_three_way(df: DataFrame, key: str, label: str, val_frac: float, test_frac: float,
                         out: str = "split") -> DataFrame:
    """B02 (3-way): per class test first, then validation, rest train."""
    p = _class_positions(df, key, label)
    c1 = F.floor(F.col("_n") * F.lit(float(test_frac)))
    c2 = c1 + F.floor(F.col("_n") * F.lit(float(val_frac)))
    return (p.withColumn(out, F.when(F.col("_pos") <= c1, F.lit("test")).when(F.col("_pos") <= c2, F.lit("val"))
                         .otherwise(F.lit("train"))).drop("_h", "_pos", "_n"))


def capped_per_class(df: DataFrame, key: str, label: str, cap: int) -> DataFrame:
    """At most ``cap`` rows per class, first in md5 order (WindowGroupLimit
    keeps the partial top-``cap`` per input partition before the shuffle)."""
    from pyspark.sql import Window
    w = Window.partitionBy(label).orderBy(key_hash(key), F.col(key))
    return df.where(F.col(label).isNotNull()).withColumn("_rn", F.row_number().over(w)) \
        .where(F.col("_rn") <= cap).drop("_rn")


def fixed_size_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows with the smallest md5 bucket (TakeOrderedAndProject)."""
    return df.withColumn("_h", key_hash(key)).orderBy("_h", key).limit(n).drop("_h")


def kfold(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    """fold = md5 bucket mod k (usable as ``CrossValidator(foldCol=...)``)."""
    return df.withColumn(out, F.pmod(key_hash(key), F.lit(k)).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, out: str = "fold") -> DataFrame:
    """Per class, ``ntile(k)`` over md5 order, 0-based."""
    p = _class_positions(df, key, label)
    return p.withColumn(out, ntile_from_position(F.col("_pos"), F.col("_n"), k) - 1).drop("_h", "_pos", "_n")


def nested_fractions(df: DataFrame, key: str, fractions: Sequence[float]) -> DataFrame:
    """Learning-curve samples nested by construction: row at md5 position
    p belongs to fraction f when ``p <= floor(f * n)``. Returns
    ``(fraction, n_rows)`` plus the positioned rows via ``positioned_rows``."""
    pos = positioned_rows(df, key)
    n = df.count()
    rows = [(float(f), int(f * n)) for f in fractions]
    spark = df.sparkSession
    cuts = spark.createDataFrame(rows, "fraction double, cut long")
    # one pass: every row counts toward all fractions whose cut covers it
    flags = pos.select(F.explode(F.array(*[F.when(F.col("_pos") <= F.lit(c), F.lit(f)) for f, c in rows])).alias("fraction")) \
        .where(F.col("fraction").isNotNull()).groupBy("fraction").agg(F.count(F.lit(1)).alias("n_rows"))
    return F.broadcast(cuts).join(flags, "fraction", "left").select(
        "fraction", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def positioned_rows(df: DataFrame, key: str) -> DataFrame:
    base = df.withColumn("_h", key_hash(key))
    return row_positions(base, ["_h", key], [], out="_pos")
