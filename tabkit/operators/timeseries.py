"""Time-series operators (Q02-Q11).

A series may hold a third of all rows, so nothing here uses
``Window.partitionBy(series)`` over raw rows. Rows are laid out in blocks
(``order.ordered_blocks``: a hot series spans many); the rows next to a block's
border are also given to the neighbouring block, and native windows run inside
each (block, series). Only a window's width travels twice, nothing is joined to
itself and no row is multiplied by a window or lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import scalars
from .order import ntile_from_position, ordered_blocks, row_positions, same_groups


def _positions(df, order_cols, series):
    return row_positions(df, order_cols, series, out="_pos")


def with_halo(df: DataFrame, order_cols: Sequence[str], series: Sequence[str] = (), back: int = 0, ahead: int = 0,
              num_partitions: int | None = None):
    """(rows, window): ``df`` plus ``_pos`` (1-based place in the series), ``_blk``
    and ``_halo``, and the window to use on it. A block also holds, marked by
    ``_halo``, the ``back`` rows of each of its series before its first own row and
    the ``ahead`` rows after its last one, so lags, leads and frames of that reach
    are right on its own rows. A null series is a series of its own."""
    s = list(series)
    rows = ordered_blocks(df, order_cols, s, num_partitions)
    inside, along = Window.partitionBy("_blk", *s).orderBy("_idx"), Window.partitionBy(*s).orderBy("_blk")
    # a row a block and series: its number k in the series, and the place of its first row
    runs = rows.groupBy("_blk", *s).agg(F.count(F.lit(1)).alias("_n"))
    runs = (runs.withColumn("_k", F.row_number().over(along))
            .withColumn("_first", F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n") + 1)
            .withColumn("_runs", F.count(F.lit(1)).over(Window.partitionBy(*s))))
    names = [f"_s{i}" for i in range(len(s))]
    runs = runs.select(F.col("_blk").alias("_b"), *[F.col(c).alias(n) for c, n in zip(s, names, strict=True)],
                       "_n", "_k", "_first", "_runs")
    own = (rows.join(runs, (F.col("_blk") == F.col("_b")) & same_groups(s, names))
           .withColumn("_pos", (F.col("_first") + F.row_number().over(inside) - 1).cast("long")))
    kept = [*df.columns, "_pos", "_blk"]
    out = own.select(*kept, F.lit(False).alias("_halo"))
    # blocks that a border row may reach: one, or more where middle blocks are shorter than the window
    least = scalars(runs.where((F.col("_k") > 1) & (F.col("_k") < F.col("_runs"))).agg(F.min("_n").alias("n")))["n"]
    spanning = own.where(F.col("_runs") > 1)
    for reach, sign in ((back, 1), (ahead, -1)):
        if not reach:
            continue
        steps = 1 + (-(-reach // least) if least else 0)
        last = F.col("_first") + F.col("_n") - 1
        near = (last - F.col("_pos") < reach) if sign > 0 else (F.col("_pos") - F.col("_first") < reach)
        border = spanning.where(near).select(*df.columns, "_pos", F.explode(
            F.sequence(F.col("_k") + sign, F.col("_k") + sign * steps)).alias("_to"))
        target = runs.select(F.col("_b").alias("_blk"), *names, F.col("_k").alias("_to"), "_first", "_n")
        halo = border.join(target, (border["_to"] == target["_to"]) & same_groups(s, names))
        close = ((F.col("_first") - F.col("_pos") <= reach) if sign > 0
                 else (F.col("_pos") - (F.col("_first") + F.col("_n") - 1) <= reach))
        out = out.unionByName(halo.where(close).select(*kept, F.lit(True).alias("_halo")))
    return out, Window.partitionBy("_blk", *s).orderBy("_pos")


def _own(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("_halo")).drop("_halo", "_blk").withColumnRenamed("_pos", "pos")


def lag_lead(df: DataFrame, value: str, order_cols: Sequence[str], series: Sequence[str] = (),
             lag: int = 1, lead: int = 1, drop_incomplete: bool = True) -> DataFrame:
    """Q02: ``{value}_x`` = value ``lag`` rows before, ``{value}_y`` = value
    ``lead`` rows after, within each series; rows without such a row are dropped
    (a null value there is a value)."""
    rows, w = with_halo(df, order_cols, series, lag, lead)
    out = (rows.withColumn(f"{value}_x", F.lag(value, lag).over(w)).withColumn(f"{value}_y", F.lead(value, lead).over(w))
           .withColumn("_there", F.lead(F.lit(True), lead).over(w) & F.lag(F.lit(True), lag).over(w)))
    out = _own(out.where("_there") if drop_incomplete else out)
    return out.drop("_there")


def difference(df: DataFrame, value: str, order_cols: Sequence[str], series: Sequence[str] = (),
               out: str | None = None) -> DataFrame:
    """Q03: first difference ``x_t - x_{t-1}`` (null for the first row of a series)."""
    rows, w = with_halo(df, order_cols, series, 1)
    return _own(rows.withColumn(out or f"{value}_diff", F.col(value) - F.lag(value, 1).over(w)))


def rolling_mean(df: DataFrame, value: str, order_cols: Sequence[str], window: int,
                 series: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Q04: rolling mean over the last ``window`` rows, ``min_periods=1`` (nulls
    count as no value)."""
    rows, w = with_halo(df, order_cols, series, window - 1)
    mean = F.avg(F.col(value).cast("double")).over(w.rowsBetween(1 - window, 0))
    return _own(rows.withColumn(out or f"{value}_roll{window}", mean))


def past_windows(df: DataFrame, value: str, order_cols: Sequence[str], past: int, future: int = 1,
                 target: str | None = None, series: Sequence[str] = ()) -> DataFrame:
    """Q05: for each row t the array of the ``past`` previous values and the
    target ``future`` rows ahead (``future=1``: the row's own target); rows
    without a full window or without the future target are excluded."""
    rows, w = with_halo(df, order_cols, series, past, future - 1)
    # structs keep null values in their places
    held = F.collect_list(F.struct(F.col(value).cast("double").alias("v"))).over(w.rowsBetween(-past, -1))
    ahead = F.lead(F.struct(F.col(target or value).alias("y")), future - 1).over(w)
    out = rows.withColumn("_held", held).withColumn("_y", ahead).where((F.size("_held") == past) & F.col("_y").isNotNull())
    return _own(out.withColumn("window", F.transform("_held", lambda x: x["v"])).withColumn("y", F.col("_y.y"))).drop("_held", "_y")


def autocorrelation(df: DataFrame, value: str, order_cols: Sequence[str], max_lag: int) -> DataFrame:
    """Q06: ``acf(k) = sum((x_t - m)(x_{t+k} - m)) / sum((x_t - m)^2)`` for k = 0..max_lag
    (statsmodels' biased estimator): one aggregate over rows that see their
    ``max_lag`` successors. A constant series has nulls."""
    rows, w = with_halo(df.select(value, *order_cols), order_cols, (), 0, max_lag)
    m = scalars(df.agg(F.avg(F.col(value).cast("double")).alias("m")))["m"]
    xc = F.col(value).cast("double") - F.lit(m)
    seen = rows.withColumn("_x", xc)
    seen = seen.select("_halo", "_x", *[F.lead("_x", k).over(w).alias(f"_x{k}") for k in range(1, max_lag + 1)])
    one = seen.where(~F.col("_halo")).agg(F.sum(F.col("_x") * F.col("_x")).alias("_0"),
                                          *[F.sum(F.col("_x") * F.col(f"_x{k}")).alias(f"_{k}") for k in range(1, max_lag + 1)])
    lags = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.coalesce(F.col(f"_{k}"), F.lit(0.0)) / F.nullif(F.col("_0"), F.lit(0.0))).alias("acf"))
                               for k in range(max_lag + 1)])).alias("s")
    return one.select(lags).select("s.*")


def pacf_from_acf(acf: Sequence[float]) -> list[float]:
    """Q07: partial autocorrelation by Durbin-Levinson on <= max_lag+1 numbers (driver)."""
    r = list(acf)
    out = [1.0]
    phi_prev: list[float] = []
    v = 1.0
    for k in range(1, len(r)):
        if k == 1:
            phi_kk = r[1]
            phi = [phi_kk]
        else:
            num = r[k] - sum(phi_prev[j] * r[k - 1 - j] for j in range(k - 1))
            phi_kk = num / v if v else float("nan")
            phi = [phi_prev[j] - phi_kk * phi_prev[k - 2 - j] for j in range(k - 1)] + [phi_kk]
        v = v * (1 - phi_kk ** 2)
        out.append(phi_kk)
        phi_prev = phi
    return out


def sequential_batches(df: DataFrame, order_cols: Sequence[str], k: int, out: str = "batch") -> DataFrame:
    """Q08: ``ntile(k)`` over a global order (batches never overlap; rule M19)."""
    pos = _positions(df, order_cols, [])
    n = scalars(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    return (pos.withColumn(out, ntile_from_position(F.col("_pos"), F.lit(n).cast("long"), k))
            .withColumnRenamed("_pos", "pos"))


def cumulative_sum(df: DataFrame, value: str, order_cols: Sequence[str], series: Sequence[str] = (),
                   out: str | None = None) -> DataFrame:
    """Q09: running sum per series in order (range-partitioned prefix sum)."""
    from .order import prefix_sum
    return prefix_sum(df, order_cols, value, series, out or f"{value}_cum")


def last_fraction_split(df: DataFrame, order_cols: Sequence[str], test_frac: float,
                        out: str = "split") -> DataFrame:
    """Q11: first ``int(n * (1 - f))`` rows in time order are ``train``, the rest ``test``."""
    pos = _positions(df, order_cols, [])
    n = scalars(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    cut = int(n * (1.0 - test_frac))
    return (pos.withColumn(out, F.when(F.col("_pos") <= F.lit(cut), F.lit("train")).otherwise(F.lit("test")))
            .withColumnRenamed("_pos", "pos"))
