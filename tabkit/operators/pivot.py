"""Group statistics, pivots and contingency tables.

Pivots run on already-aggregated tables (one row per cell), so the pivot
itself never sees data-sized input. Pivot values are passed explicitly when
known to avoid the extra ``distinct`` job. Null keys are dropped (M6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bins import quantile_bins
from ..functions.columns import scalars
from .order import exact_quantiles
from .profile import unpivot


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def distinct_values(df: DataFrame, column: str, max_values: int = 1000) -> list:
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"too many pivot values in {column}")
    return sorted(r[0] for r in rows)


def group_stats(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                stats: Sequence[str] = ("mean", "std", "median", "count")) -> DataFrame:
    """Per group ``{col}_{stat}`` for many columns (flattened names).
    Medians for all columns come from one sort of the unpivoted table."""
    g = list(group_cols)
    base = _drop_null_keys(df, g)
    aggs = []
    for c in value_cols:
        x = F.col(c).cast("double")
        if "mean" in stats:
            aggs.append(F.avg(x).alias(f"{c}_mean"))
        if "std" in stats:
            aggs.append(F.stddev_samp(x).alias(f"{c}_std"))
        if "count" in stats:
            aggs.append(F.count(x).alias(f"{c}_count"))
        if "min" in stats:
            aggs.append(F.min(x).alias(f"{c}_min"))
        if "max" in stats:
            aggs.append(F.max(x).alias(f"{c}_max"))
        if "sum" in stats:
            aggs.append(F.sum(x).alias(f"{c}_sum"))
    out = base.groupBy(*g).agg(*aggs)
    if "median" in stats:
        long = unpivot(base.select(*g, *value_cols), value_cols, keep=g)
        med = exact_quantiles(long, "value", [0.5], g + ["column"])
        wide = med.groupBy(*g).pivot("column", list(value_cols)).agg(F.first("q_0"))
        wide = wide.select(*g, *[F.col(c).alias(f"{c}_median") for c in value_cols])
        out = out.join(wide, g, "left")
    return out


def pivot_stats(df: DataFrame, index: str, columns: str, value: str,
                aggs: Sequence[str] = ("mean", "median", "count"), values: Sequence | None = None) -> DataFrame:
    """Pivot with several aggregates; output ``{col_value}_{agg}``.
    Count of an empty cell is 0, other aggregates null."""
    base = _drop_null_keys(df, [index, columns])
    vals = list(values) if values is not None else distinct_values(base, columns)
    x = F.col(value).cast("double")
    cell_aggs = []
    if "mean" in aggs:
        cell_aggs.append(F.avg(x).alias("mean"))
    if "count" in aggs:
        cell_aggs.append(F.count(x).alias("count"))
    if "std" in aggs:
        cell_aggs.append(F.stddev_samp(x).alias("std"))
    if "sum" in aggs:
        cell_aggs.append(F.sum(x).alias("sum"))
    cells = base.groupBy(index, columns).agg(*cell_aggs) if cell_aggs else None
    if "median" in aggs:
        med = exact_quantiles(base, value, [0.5], [index, columns]).withColumnRenamed("q_0", "median")
        cells = med if cells is None else cells.join(med, [index, columns], "left")
    names = [a for a in aggs]
    wide = cells.groupBy(index).pivot(columns, vals).agg(*[F.first(a).alias(a) for a in names])
    if len(names) == 1:
        wide = wide.select(index, *[F.col(f"`{v}`").alias(f"{v}_{names[0]}") for v in vals])
    if "count" in names:
        wide = wide.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) if c.endswith("_count")
                             else F.col(f"`{c}`") for c in wide.columns])
    return wide


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Contingency counts, wide, empty cells 0 (nulls dropped)."""
    base = _drop_null_keys(df, [row, col])
    vals = list(values) if values is not None else distinct_values(base, col)
    wide = base.groupBy(row).pivot(col, vals).agg(F.count(F.lit(1)))
    return wide.na.fill(0, subset=[str(v) for v in vals])


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """G12 long form ``(row, col, n)`` (only non-empty cells)."""
    base = _drop_null_keys(df, [row, col])
    return base.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def row_normalized(df: DataFrame, row: str, col: str) -> DataFrame:
    """``(row, col, n, share)`` with shares summing to 1 per row.
    Row totals come from a grouped aggregate joined back (no global window)."""
    cells = crosstab_long(df, row, col)
    tot = cells.groupBy(row).agg(F.sum("n").alias("row_total"))
    return cells.join(tot, row).withColumn("share", F.col("n") / F.col("row_total")).drop("row_total")


def interaction_table(df: DataFrame, keys: Sequence[str], target: str, numeric_bins: dict[str, int] | None = None,
                      labels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Numeric keys quantile-binned (exact edges), then per key tuple
    mean/median/std/count of the target. Rows with a null key or target are dropped
    before binning (bins are computed per tuple, as the reference)."""
    keys = list(keys)
    base = _drop_null_keys(df.select(*keys, target), keys + [target])
    bin_keys = []
    for k in keys:
        if numeric_bins and k in numeric_bins:
            base, _ = quantile_bins(base, k, numeric_bins[k], labels=(labels or {}).get(k), out=f"{k}_bin")
            bin_keys.append(f"{k}_bin")
        else:
            bin_keys.append(k)
    base = _drop_null_keys(base, bin_keys)
    x = F.col(target).cast("double")
    st = base.groupBy(*bin_keys).agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                                     F.count(x).alias("count"))
    med = exact_quantiles(base, target, [0.5], bin_keys).withColumnRenamed("q_0", "median")
    return st.join(med, bin_keys, "left")


def union_interactions(tables: Sequence[tuple[str, DataFrame]], key_names: Sequence[str]) -> DataFrame:
    """Several pair tables unioned, key columns renamed to ``key_1..``, with a ``pair`` label."""
    out = None
    for label, t in tables:
        cols = t.columns
        keys = cols[:len(key_names)]
        t2 = t.select(F.lit(label).alias("pair"), *[F.col(k).cast("string").alias(n) for k, n in zip(keys, key_names)],
                      *[c for c in cols[len(key_names):]])
        out = t2 if out is None else out.unionByName(t2)
    return out


def binned_curve(df: DataFrame, x: str, y: str, group: str, bins: int = 10) -> DataFrame:
    """Per group, mean of ``y`` in quantile bins of ``x`` with bin midpoints."""
    base = _drop_null_keys(df.select(group, x, y), [group, x, y])
    binned, edges = quantile_bins(base, x, bins, as_index=True, out="_bin")
    mids = [(edges[i] + edges[i + 1]) / 2 for i in range(len(edges) - 1)]
    mid = F.element_at(F.array(*[F.lit(float(m)) for m in mids]), F.col("_bin") + 1)
    return (binned.where(F.col("_bin").isNotNull()).withColumn("mid", mid)
            .groupBy(group, "_bin", "mid").agg(F.avg(F.col(y).cast("double")).alias("mean_y"),
                                                F.count(F.lit(1)).alias("count"))
            .withColumnRenamed("_bin", "bin"))


def class_counts(df: DataFrame, label: str, order: Sequence | None = None) -> DataFrame:
    """``(class, count, share, ratio_to_majority, order)``, plus the
    imbalance ratio (majority/minority) on every row."""
    counts = _drop_null_keys(df, [label]).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    st = scalars(counts.agg(F.max("count").alias("mx"), F.min("count").alias("mn"), F.sum("count").alias("n")))
    out = (counts.withColumn("share", F.col("count") / F.lit(float(st["n"] or 0)))
           .withColumn("ratio_to_majority", F.col("count") / F.lit(float(st["mx"] or 0)))
           .withColumn("imbalance_ratio", F.lit(float(st["mx"]) / float(st["mn"]) if st["mn"] else None)))
    if order is not None:
        pos = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
        out = out.withColumn("order", pos[F.col(label)]).orderBy("order")
    return out


def coverage_by_feature(df: DataFrame, feature: str, labelled: Column) -> DataFrame:
    """Per feature value, share among labelled vs unlabelled rows, aligned
    by a full outer alignment (J04) with missing -> 0, and the difference."""
    base = _drop_null_keys(df, [feature]).withColumn("_lab", labelled.cast("boolean"))
    cnt = base.groupBy(feature).agg(F.count_if(F.col("_lab")).alias("n_labelled"),
                                    F.count_if(~F.col("_lab")).alias("n_unlabelled"))
    st = scalars(cnt.agg(F.sum("n_labelled").alias("a"), F.sum("n_unlabelled").alias("b")))
    return (cnt.withColumn("share_labelled", F.try_divide(F.col("n_labelled"), F.lit(float(st["a"] or 0))))
            .withColumn("share_unlabelled", F.try_divide(F.col("n_unlabelled"), F.lit(float(st["b"] or 0))))
            .withColumn("diff", F.col("share_labelled") - F.col("share_unlabelled")))


def monthly_by_class(df: DataFrame, ts: str, label: str, classes: Sequence) -> DataFrame:
    """Counts per month (wide by class) and the monthly total."""
    base = _drop_null_keys(df, [ts, label]).withColumn("month", F.date_trunc("month", F.col(ts)))
    wide = base.groupBy("month").pivot(label, list(classes)).agg(F.count(F.lit(1)))
    wide = wide.na.fill(0, subset=[str(c) for c in classes])
    total = None
    for c in classes:
        total = F.col(f"`{c}`") if total is None else total + F.col(f"`{c}`")
    return wide.withColumn("total", total)


def hourly_share(df: DataFrame, hour: Column, flag: Column) -> DataFrame:
    """Counts and flagged share per hour, all 24 hours present (empty -> 0)."""
    cnt = (df.select(hour.alias("hour"), flag.cast("boolean").alias("_f")).where(F.col("hour").isNotNull())
           .groupBy("hour").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_f")).alias("n_flag")))
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return (F.broadcast(hours).join(cnt, "hour", "left")
            .select("hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                    F.coalesce("n_flag", F.lit(0)).cast("bigint").alias("n_flag"))
            .withColumn("share", F.try_divide(F.col("n_flag"), F.col("n"))))


def risky_pairs(df: DataFrame, a: str, b: str, hit: Column, min_total: int = 20, top: int = 10) -> DataFrame:
    """Category pairs with total, hits and share; ``total >= min_total``; top by share."""
    base = _drop_null_keys(df, [a, b])
    agg = base.groupBy(a, b).agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("hits"))
    return (agg.where(F.col("total") >= min_total).withColumn("share", F.col("hits") / F.col("total"))
            .orderBy(F.col("share").desc(), F.col("total").desc(), F.col(a), F.col(b)).limit(top))


def top_categories(df: DataFrame, column: str, n: int) -> DataFrame:
    """J05 helper: the ``n`` most frequent values (ties by value), a table of <= n rows."""
    return (_drop_null_keys(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.col("_n").desc(), F.col(column)).limit(n).select(column))


def interaction_share_matrix(df: DataFrame, a: str, b: str, hit: Column, n: int = 8) -> DataFrame:
    """Mean of ``hit`` for top-n(a) x top-n(b) cells, long ``(a, b, n, share)``."""
    base = df.join(F.broadcast(top_categories(df, a, n)), a, "left_semi") \
             .join(F.broadcast(top_categories(df, b, n)), b, "left_semi")
    return base.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("share"))


def flag_class_delta(df: DataFrame, flag: str, label: str, min_group: int = 50) -> DataFrame:
    """Class shares within each flag value minus global class shares
    (points); flag groups smaller than ``min_group`` dropped."""
    base = _drop_null_keys(df, [flag, label])
    cells = base.groupBy(flag, label).agg(F.count(F.lit(1)).alias("n"))
    gsize = cells.groupBy(flag).agg(F.sum("n").alias("group_n"))
    glob = cells.groupBy(label).agg(F.sum("n").alias("class_n"))
    total = scalars(glob.agg(F.sum("class_n").alias("t")))["t"]
    glob = glob.withColumn("global_share", F.col("class_n") / F.lit(float(total or 0)))
    return (cells.join(gsize, flag).where(F.col("group_n") >= min_group)
            .join(glob.select(label, "global_share"), label)
            .withColumn("share", F.col("n") / F.col("group_n"))
            .withColumn("delta_pts", (F.col("share") - F.col("global_share")) * 100))


def majority_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent non-null ``value`` per ``key`` (ties: smallest value)."""
    base = _drop_null_keys(df, [key, value])
    cnt = base.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    # one aggregate: the smallest (-count, value) struct wins
    return cnt.groupBy(key).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(value))


def repair_by_majority(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Fill missing/wrong ``value`` with the key's majority value (one aggregate + join)."""
    maj = majority_value(df, key, value).withColumnRenamed(value, "_maj")
    return df.join(maj, key, "left").withColumn(out or value, F.coalesce(F.col("_maj"), F.col(value))).drop("_maj")


def total_mean_per_key(df: DataFrame, key: str, value: str, descending: bool = True) -> DataFrame:
    """Total and mean per key, sorted by total."""
    agg = _drop_null_keys(df, [key]).groupBy(key).agg(F.sum(F.col(value)).alias("total"),
                                                     F.avg(F.col(value)).alias("mean"))
    return agg.orderBy(F.col("total").desc() if descending else F.col("total").asc(), F.col(key))


def duplicate_stats(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Rows, distinct rows on ``cols``, duplicates and distinct share."""
    if len(cols) == 1:
        c = F.col(cols[0])
        if isinstance(df.schema[cols[0]].dataType, T.StringType):
            # whole texts: distinct on a SHA-256 digest shuffles 32 bytes per row
            # instead of the text (collisions are negligible)
            c = F.sha2(c, 256)
        dc = F.approx_count_distinct(c) if approx else F.count_distinct(c)
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), dc.alias("n_distinct"))
    else:
        n = df.agg(F.count(F.lit(1)).alias("n_rows"))
        d = df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
        st1, st2 = scalars(n), scalars(d)
        one = df.sparkSession.createDataFrame([(st1["n_rows"], st2["n_distinct"])], "n_rows bigint, n_distinct bigint")
    return (one.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
            .withColumn("distinct_share", F.try_divide(F.col("n_distinct"), F.col("n_rows"))))


def split_class_shares(df: DataFrame, label: str, split: str, splits: Sequence[str],
                       reference: str = "original") -> DataFrame:
    """Class share per split (wide), plus the original shares and deltas in points."""
    base = _drop_null_keys(df, [label])
    cnt = base.groupBy(label).pivot(split, list(splits)).agg(F.count(F.lit(1)))
    cnt = cnt.na.fill(0, subset=list(splits))
    tot = scalars(cnt.agg(*[F.sum(F.col(s)).alias(s) for s in splits]))
    allc = None
    for s in splits:
        allc = F.col(s) if allc is None else allc + F.col(s)
    out = cnt.withColumn(reference, allc)
    grand = sum(float(tot[s] or 0) for s in splits)
    out = out.withColumn(f"{reference}_share", F.col(reference) / F.lit(grand))
    for s in splits:
        out = out.withColumn(f"{s}_share", F.try_divide(F.col(s), F.lit(float(tot[s] or 0))))
        out = out.withColumn(f"{s}_delta_pts", (F.col(f"{s}_share") - F.col(f"{reference}_share")) * 100)
    return out


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Means of all numerics per cluster, plus the cluster size."""
    return (_drop_null_keys(df, [cluster]).groupBy(cluster)
            .agg(F.count(F.lit(1)).alias("size"), *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in cols]))
