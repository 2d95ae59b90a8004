"""Binning (P08, P09) with pandas ``cut``/``qcut`` semantics (rules M4, M5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col, scalars


def cut_expr(c: str | Column, edges: Sequence[float], labels: Sequence | None = None,
             right: bool = True, include_lowest: bool = True, as_index: bool = False) -> Column:
    """``pd.cut``: ``(a, b]`` bins (first bin closed when ``include_lowest``),
    values outside the edges -> null. Returns the label, or the 0-based bin id
    when ``as_index``."""
    x = col(c)
    e = [float(v) for v in edges]
    expr = None
    for i in range(len(e) - 1):
        lo, hi = e[i], e[i + 1]
        if right:
            lower_ok = (x >= F.lit(lo)) if (i == 0 and include_lowest) else (x > F.lit(lo))
            cond = lower_ok & (x <= F.lit(hi))
        else:
            upper_ok = (x <= F.lit(hi)) if (i == len(e) - 2 and include_lowest) else (x < F.lit(hi))
            cond = (x >= F.lit(lo)) & upper_ok
        val = F.lit(i) if as_index or labels is None else F.lit(labels[i])
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def interval_labels(edges: Sequence[float], digits: int = 3) -> list[str]:
    """Text labels ``(a, b]`` for unlabeled bins."""
    fmt = lambda v: f"{round(float(v), digits):g}"
    return [f"({fmt(edges[i])}, {fmt(edges[i + 1])}]" for i in range(len(edges) - 1)]


def fixed_bins(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str] | None = None,
               out: str | None = None) -> DataFrame:
    """Fixed-edge binning with labels (``pd.cut(right=True, include_lowest=True)``)."""
    labs = list(labels) if labels is not None else interval_labels(edges)
    return df.withColumn(out or f"{column}_bin", cut_expr(column, edges, labs))


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """Edges of ``pd.qcut(q, duplicates="drop")``: exact quantiles 0, 1/q, ..., 1,
    duplicates removed. Only ``q+1`` numbers reach the driver."""
    from ..operators.order import quantile_values
    probs = [i / q for i in range(q + 1)]
    vals = [v for v in quantile_values(df, column, probs) if v is not None]
    edges = []
    for v in vals:
        if not edges or v != edges[-1]:
            edges.append(v)
    return edges


def quantile_bins(df: DataFrame, column: str, q: int = 4, labels: Sequence[str] | None = None,
                  out: str | None = None, fallback_bins: int | None = None,
                  as_index: bool = False) -> tuple[DataFrame, list[float]]:
    """Quantile binning; when fewer than 2 distinct edges remain, falls
    back to ``fallback_bins`` equal-width bins over [min, max]."""
    edges = quantile_edges(df, column, q)
    if len(edges) < 2 and fallback_bins:
        st = scalars(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
        lo, hi = float(st["lo"]), float(st["hi"])
        width = (hi - lo) / fallback_bins if hi > lo else 1.0
        edges = [lo + i * width for i in range(fallback_bins + 1)]
    labs = None
    if labels is not None and len(labels) == len(edges) - 1:
        labs = list(labels)
    elif not as_index:
        labs = interval_labels(edges)
    expr = cut_expr(column, edges, labs, as_index=as_index or labs is None)
    return df.withColumn(out or f"{column}_qbin", expr), edges


def equal_width_bucket(c: str | Column, lo: float, hi: float, n: int) -> Column:
    """G29 helper: 0-based equal-width bin in [lo, hi] (``hi`` in the last bin)."""
    x = col(c)
    w = (hi - lo) / n if hi > lo else 1.0
    b = F.floor((x - F.lit(lo)) / F.lit(w)).cast("int")
    return F.when(x.isNull(), None).when(b >= n, F.lit(n - 1)).when(b < 0, F.lit(0)).otherwise(b)
