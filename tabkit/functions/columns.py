"""Projections and scalar feature functions.

Each function is a pure column expression builder or a ``df -> df``
projection, so Catalyst collapses chains of them into one ``Project`` inside
whole-stage codegen.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division with 0 or null denominator -> null (rule M10)."""
    return F.try_divide(col(num), col(den))


def clip_lower(c: str | Column, lower: float = 0.0) -> Column:
    """``clip(lower=...)`` that keeps nulls (rule M9)."""
    x = col(c)
    return F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{name: (num, den)}``; specs naming missing columns are skipped."""
    new = {name: safe_div(n, d) for name, (n, d) in ratios.items()
           if n in df.columns and d in df.columns}
    return df.withColumns(new) if new else df


def log_features(df: DataFrame, cols: Sequence[str], prefix: str = "log_") -> DataFrame:
    """``log_<c> = log1p(clip(c, 0))``; missing columns skipped."""
    new = {f"{prefix}{c}": F.log1p(clip_lower(c, 0.0)) for c in cols if c in df.columns}
    return df.withColumns(new) if new else df


def plain_log(c: str | Column, plus_one: bool = False) -> Column:
    """``ln(x)`` or ``ln(x+1)``; non-positive input -> null (Spark ``ln``)."""
    x = col(c)
    return F.ln(x + F.lit(1.0)) if plus_one else F.ln(x)


def point_distances(df: DataFrame, x: str, y: str, points: Mapping[str, tuple[float, float]],
                    prefix: str = "dist_", min_name: str = "dist_min",
                    nearest_name: str | None = "nearest") -> DataFrame:
    """Euclidean distance to named points, the minimum and the argmin name."""
    if x not in df.columns or y not in df.columns:
        return df
    dists = {f"{prefix}{name}": F.sqrt(F.pow(F.col(x) - F.lit(float(px)), 2) +
                                       F.pow(F.col(y) - F.lit(float(py)), 2))
             for name, (px, py) in points.items()}
    out = df.withColumns(dists)
    out = out.withColumn(min_name, F.least(*[F.col(k) for k in dists]))
    if nearest_name:
        # Ties go to the first point in the given order (as numpy argmin).
        structs = [F.struct(F.col(k).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("n"))
                   for i, (k, name) in enumerate(zip(dists, points))]
        out = out.withColumn(nearest_name, F.array_min(F.array(*structs))["n"])
    return out


def polynomial_features(df: DataFrame, specs: Sequence[Sequence[str]]) -> DataFrame:
    """One column -> square ``c_sq``; two columns -> product ``a_x_b``; others skipped."""
    new = {}
    for spec in specs:
        spec = list(spec)
        if any(c not in df.columns for c in spec):
            continue
        if len(spec) == 1:
            new[f"{spec[0]}_sq"] = F.pow(F.col(spec[0]), 2)
        elif len(spec) == 2:
            new[f"{spec[0]}_x_{spec[1]}"] = F.col(spec[0]) * F.col(spec[1])
        else:
            warnings.warn(f"polynomial spec with {len(spec)} columns skipped: {spec}")
    return df.withColumns(new) if new else df


def binary_flags(df: DataFrame, flags: Sequence[Mapping]) -> DataFrame:
    """``{column, value, new_column}`` -> 0/1 (null input -> 0)."""
    new = {f["new_column"]: F.coalesce((F.col(f["column"]) == F.lit(f["value"])).cast("int"), F.lit(0))
           for f in flags if f["column"] in df.columns}
    return df.withColumns(new) if new else df


def ordinal_map(df: DataFrame, column: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """P10: dict lookup; unknown -> null. The dict is a literal map (no join)."""
    if column not in df.columns:
        return df
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    m = F.create_map(*kv)
    return df.withColumn(out or f"{column}_ord", m[F.col(column)])


def one_hot(df: DataFrame, column: str, values: Sequence, prefix: str | None = None,
            drop_first: bool = False, drop_source: bool = True) -> DataFrame:
    """``prefix_value`` 0/1 columns for the (sorted) fitted values; null -> all 0."""
    vals = sorted(values)
    if drop_first:
        vals = vals[1:]
    p = prefix or column
    new = {f"{p}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in vals}
    out = df.withColumns(new)
    return out.drop(column) if drop_source else out


def fit_one_hot_values(df: DataFrame, column: str, max_values: int = 10_000) -> list:
    """Fit step of P11: distinct non-null values, bounded (one small job)."""
    rows = (df.select(column).where(F.col(column).isNotNull()).distinct()
            .limit(max_values + 1).collect())
    if len(rows) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values")
    return sorted(r[0] for r in rows)


def select_features(df: DataFrame, cols: Sequence[str], fill_missing: float | None = None) -> DataFrame:
    """Keep listed columns; missing ones skipped, or added as a constant at scoring."""
    out = []
    for c in cols:
        if c in df.columns:
            out.append(F.col(c))
        elif fill_missing is not None:
            out.append(F.lit(fill_missing).alias(c))
    return df.select(*out)


def clean_name(name: str) -> str:
    """``<`` -> ``lt_``, ``[``/``]`` -> ``(``/``)``, lower case, spaces -> ``_``."""
    s = name.replace("<", "lt_").replace("[", "(").replace("]", ")")
    s = s.strip().lower()
    return re.sub(r"\s+", "_", s)


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: clean_name(c) for c in df.columns if clean_name(c) != c})


def recode(c: str | Column, cases: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Ordered ``when`` chain ``[(predicate, value), ...]``."""
    expr = None
    for pred, val in cases:
        expr = F.when(pred, F.lit(val)) if expr is None else expr.when(pred, F.lit(val))
    if expr is None:
        return col(c)
    return expr.otherwise(col(c) if otherwise is None else F.lit(otherwise))


def zscore(c: str | Column, mean: Column, std: Column) -> Column:
    """P18 helper: (x - mean)/std with std 0 -> null."""
    return F.try_divide(col(c) - mean, std)


def scalars(agg_df: DataFrame) -> dict:
    """Collect a one-row aggregate (fitted parameters) to the driver."""
    rows = agg_df.take(2)
    if len(rows) != 1:
        raise ValueError("expected a one-row aggregate")
    return rows[0].asDict()


def zscore_flags(df: DataFrame, cols: Sequence[str], k: float = 3.0, ddof: int = 1) -> DataFrame:
    """Add ``z_<c>`` and ``out_<c>`` (|z| > k). Mean/std are fitted in one
    ``agg`` and enter the projection as literals (the fitted state is 2 numbers
    per column, independent of the data size)."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = scalars(df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), sd(c).alias(f"s_{c}"))]))
    new = {}
    for c in cols:
        z = zscore(c, F.lit(st[f"m_{c}"]).cast("double"), F.lit(st[f"s_{c}"]).cast("double"))
        new[f"z_{c}"] = z
        new[f"out_{c}"] = (F.abs(z) > F.lit(k)).cast("int")
    return df.withColumns(new)


def row_key(cols: Sequence[str], digits: int = 12, sep: str = "|") -> Column:
    """P20: composite key of rounded values joined as text."""
    parts = [F.round(F.col(c), digits).cast("string") for c in cols]
    return F.concat_ws(sep, *parts)


def rescale_array(c: str | Column, factor: float) -> Column:
    """Divide every element of an array column by a constant."""
    return F.transform(col(c), lambda x: x / F.lit(float(factor)))


def prediction_interval(pred: str | Column, std: str | Column, folds: int = 5, z: float = 1.96):
    """``(lower, upper) = pred -/+ z * std / sqrt(folds)``."""
    half = F.lit(float(z)) * col(std) / F.lit(float(folds) ** 0.5)
    return (col(pred) - half), (col(pred) + half)


def threshold_decision(p: str | Column, t: float) -> Column:
    """Strict ``p > t`` as 0/1."""
    return (col(p) > F.lit(float(t))).cast("int")


def cap_at(c: str | Column, q_value: Column) -> Column:
    """Cap values above a quantile (given as a one-row column)."""
    x = col(c)
    return F.when(x > q_value, q_value).otherwise(x)
