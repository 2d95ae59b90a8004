"""Global order computations without a one-partition window.

Spark's ``Window.orderBy`` without ``partitionBy`` moves every row into one
task. Here running sums come from blocks: rows are range-partitioned on the
order key (a hot group is split across ranges by its values) and landed with
their block and place in it; the sums of each (block, group) are turned into
offsets by a window over one row per block and group; a window inside each
(block, group) does the rest. Everything is native, so integers, decimals and
nulls keep Spark's exact arithmetic.

Average ranks with ties (Q01) use the running sum over ``(value, count)`` pairs,
so the data is first collapsed to distinct values (map-side combined). Exact
quantiles need no order at all: they refine the buckets that hold a target rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the lineage
    ends in files that outlive any executor."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_blocks(df: DataFrame, order_cols: Sequence[str | Column], group_cols: Sequence[str] = (),
                   num_partitions: int | None = None) -> DataFrame:
    """``df`` in (group, order) order, landed with ``_blk`` (its range) and ``_idx``
    (ascending inside it). Ranges: the caller's count, else the configured shuffle
    partitions, which adaptive execution coalesces by size; never the number of cores."""
    keys = [F.col(c) for c in group_cols] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return land(ranged.sortWithinPartitions(*keys).withColumn("_blk", F.spark_partition_id())
                .withColumn("_idx", F.monotonically_increasing_id()), "ranges")


def same_groups(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def prefix_sum(df: DataFrame, order_cols: Sequence[str | Column], weight: str | Sequence[str] | None = None,
               group_cols: Sequence[str] = (), out: str | Sequence[str] = "cum",
               num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (1 per row if None) in ``order_cols``
    order (names or sort-order Columns such as ``F.col(x).desc()``), restarting
    per ``group_cols``; several weights give as many ``out`` columns from one
    layout. Sums have the type of Spark's ``sum`` (long for integers, a wider
    decimal for decimals) and are exact for both; a null weight adds nothing.
    Give a unique order key for deterministic positions (use ``average_rank`` for
    tie-aware ranks). A null group is a group of its own; an empty table gives none.

    Plan: range partition + sort, landed once in the shared checkpoint folder (so
    the layout is computed once and survives executor loss), then one aggregate
    per (block, group) and a window inside each."""
    g = list(group_cols)
    weights = [weight] if weight is None or isinstance(weight, str) else list(weight)
    outs = [out] if isinstance(out, str) else list(out)
    rows = ordered_blocks(df, order_cols, g, num_partitions)
    one = [F.lit(1).cast("long") if w is None else F.coalesce(F.col(w), F.lit(0).cast(rows.schema[w].dataType)) for w in weights]
    totals = rows.groupBy("_blk", *g).agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(one)])
    before = Window.partitionBy(*g).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)  # a row a block and group
    base = totals.select(F.col("_blk").alias("_b"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)],
                         *[F.sum(f"_t{i}").over(before).alias(f"_base{i}") for i in range(len(one))])
    # only groups that go on from an earlier block have a base
    base = base.where(F.col("_base0").isNotNull())
    on = (F.col("_blk") == F.col("_b")) & same_groups(g, [f"_g{i}" for i in range(len(g))])
    inside = Window.partitionBy("_blk", *g).orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    sums = {o: F.sum(c).over(inside) + F.coalesce(F.col(f"_base{i}"), F.lit(0)) for i, (o, c) in enumerate(zip(outs, one, strict=True))}
    for i, (o, c) in enumerate(zip(outs, one, strict=True)):
        # the running sum's own type, not widened by the offset
        kind = totals.schema[f"_t{i}"].dataType
        sums[o] = sums[o].cast(kind)
    return rows.join(base, on, "left").select(*[F.col(c) for c in df.columns], *[c.alias(o) for o, c in sums.items()])


def row_positions(df: DataFrame, order_cols: Sequence[str | Column], group_cols: Sequence[str] = (),
                  out: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """1-based row position in a (unique) order, per group, without a one-task window."""
    return prefix_sum(df, order_cols, None, group_cols, out, num_partitions)


def group_sizes(df: DataFrame, group_cols: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(out))


def ntile_from_position(pos: Column, n: Column, k: int) -> Column:
    """``ntile(k)`` from a 1-based position and the group size: the first
    ``n % k`` tiles get one extra row (SQL semantics)."""
    size = F.floor(n / F.lit(k))
    rem = n - size * F.lit(k)
    p0 = pos - F.lit(1)
    big = rem * (size + F.lit(1))
    return (F.when(p0 < big, F.floor(p0 / (size + F.lit(1))))
            .otherwise(rem + F.floor((p0 - big) / F.when(size > 0, size).otherwise(F.lit(1))))
            + F.lit(1)).cast("int")


def value_positions(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                    num_partitions: int | None = None) -> DataFrame:
    """Distinct ``(group, value)`` with count ``n`` and 1-based positions
    ``pos_start``/``pos_end`` in the ascending sort of the group's values; null and NaN are no values."""
    g = list(group_cols)
    present = F.col(value_col).isNotNull()
    if isinstance(df.schema[value_col].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value_col)
    cnt = (df.where(present)
           .groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("n")))
    for c in g:
        cnt = cnt.where(F.col(c).isNotNull())
    cum = prefix_sum(cnt, [value_col], weight="n", group_cols=g, out="pos_end",
                     num_partitions=num_partitions)
    return cum.withColumn("pos_start", F.col("pos_end") - F.col("n") + F.lit(1))


def average_rank(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                 out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Q01: average rank of each distinct value (ties share the mean position),
    as in ``scipy.stats.rankdata``. Returns ``(group..., value, n, rank)``."""
    pos = value_positions(df, value_col, group_cols, num_partitions)
    return pos.select(*group_cols, value_col, "n",
                      ((F.col("pos_start") + F.col("pos_end")) / F.lit(2.0)).alias(out))


def rank_rows(df: DataFrame, value_col: str, out: str = "rank") -> DataFrame:
    """Q01 joined back to the rows (each row gets its value's average rank).
    A hot value makes this join skewed; AQE's skew join splits that partition."""
    ranks = average_rank(df, value_col).select(value_col, out)
    return df.join(ranks, value_col, "left")


#: Buckets of a unit of log(1 + |value|), parts of a bucket that is refined, and
#: rows of a bucket from which it is (its distinct values meet in one window).
LOG_BUCKETS, PARTS, REFINED_ROWS = 1024, 1 << 20, 1_000_000


def _targets(n: Column, probs: Sequence[float]) -> Column:
    """0-based ranks below and above each quantile, in order of ``probs``."""
    h = [(n - 1).cast("double") * F.lit(float(p)) for p in probs]
    return F.array(*[F.floor(x) for x in h], *[F.ceil(x) for x in h])


def _holding(counts: DataFrame, within: list[str], by: str, carried: list[str], probs: Sequence[float], whole: bool) -> DataFrame:
    """Rows of ``counts`` (within, by, n) that hold a target rank, with ``before``:
    the values before them. ``whole``: the table holds all values, else it
    carries the values before each bucket and their number ``total``."""
    order = Window.partitionBy(*within).orderBy(by) if within else Window.orderBy(by)
    run = counts.withColumn("_run", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    if whole:
        total = Window.partitionBy(*within) if within else Window.partitionBy()
        run = run.withColumn("total", F.sum("n").over(total)).withColumn("before", F.lit(0).cast("long"))
    start = F.col("before") + F.col("_run") - F.col("n")
    held = F.filter(_targets(F.col("total"), probs), lambda r: (r >= start) & (r < start + F.col("n")))
    return run.where(F.size(held) > 0).select(*within, by, "n", "total", start.alias("before"), *carried)


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), num_partitions: int | None = None,
                    long: bool = False) -> DataFrame:
    """Exact, linearly interpolated quantiles (pandas/numpy default, rule M3).

    ``percentile`` buffers all values of a group in one aggregation buffer; a
    sort moves every row. This counts values in buckets of their logarithm, keeps
    the buckets that hold a target rank, cuts those of many rows into parts between
    their least and largest value as often as it takes, and then counts distinct
    values in what is left. Each pass is a scan with map-side counts; windows run
    over counts only, and the rows meet small tables of buckets. Buckets are
    monotone in the value, so any rounding in them is harmless. Null and NaN are no
    values; infinite ones sort as such. Null groups are left out.
    Output: ``(group..., q_<i>)`` for each prob, or long ``(group..., prob, value)``;
    a group without values has no row (without groups: a row of nulls)."""
    g = list(group_cols)
    k = len(probs)
    v = F.col(value_col)
    present = v.isNotNull()
    if isinstance(df.schema[value_col].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value_col)
    for c in g:
        present = present & F.col(c).isNotNull()
    names = [f"_g{i}" for i in range(len(g))]
    d = F.col("_v").cast("double")
    log = F.floor(F.signum(d) * F.log1p(F.abs(d)) * LOG_BUCKETS)
    b1 = F.when(F.abs(d) == float("inf"), F.signum(d) * F.lit(1 << 40)).otherwise(log).cast("long")
    rows = (df.where(present).select(*[F.col(c).alias(n) for c, n in zip(g, names)], v.alias("_v")).withColumn("_b1", b1))
    ends = [F.min(d).alias("_lo"), F.max(d).alias("_hi")]
    counts = rows.groupBy(*names, "_b1").agg(F.count(F.lit(1)).alias("n"), *ends)
    held = land(_holding(counts, names, "_b1", ["_lo", "_hi"], probs, True), "buckets")
    keys, carried = [*names, "_b1"], [F.max("total").alias("total"), F.max("before").alias("before")]
    while (held.where("_lo < _hi").agg(F.max("n").alias("n")).first()["n"] or 0) > REFINED_ROWS:
        part = F.floor((d / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * (PARTS - 1))
        deeper = f"_b{len(keys) - len(names) + 1}"
        inner = (rows.join(held.drop("n"), keys)
                 .withColumn(deeper, F.when(F.col("_lo") == F.col("_hi"), F.lit(0)).otherwise(part).cast("long")))
        counts = inner.groupBy(*keys, deeper).agg(F.count(F.lit(1)).alias("n"), *carried, *ends)
        held = land(_holding(counts, keys, deeper, ["_lo", "_hi"], probs, False), "buckets")
        rows, keys = inner.drop("total", "before", "_lo", "_hi"), [*keys, deeper]
    last = rows.join(held.drop("n", "_lo", "_hi"), keys).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("n"), *carried)
    last = _holding(last, keys, "_v", [], probs, False)
    at = _targets(F.col("total"), probs)
    aggs = [F.max("total").alias("_N")]
    for i in range(2 * k):
        r = F.element_at(at, i + 1)
        aggs.append(F.max(F.when((r >= F.col("before")) & (r < F.col("before") + F.col("n")), d)).alias(f"_x{i}"))
    agg = last.groupBy(*names).agg(*aggs) if g else last.agg(*aggs)
    qcols = []
    for i, p in enumerate(probs):
        h = (F.col("_N") - 1).cast("double") * F.lit(float(p))
        low, high = F.col(f"_x{i}"), F.col(f"_x{k + i}")
        qcols.append(F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h))).alias(f"q_{i}"))
    wide = agg.select(*[F.col(n).alias(c) for c, n in zip(g, names)], *qcols)
    if not long:
        return wide
    st = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(f"q_{i}").alias("value"))
                             for i, p in enumerate(probs)])).alias("s")
    return wide.select(*g, st).select(*g, "s.prob", "s.value")


def quantile_values(df: DataFrame, value_col: str, probs: Sequence[float]) -> list[float]:
    """Driver-side list of a few exact quantiles (fitted parameters such as bin edges)."""
    row = exact_quantiles(df, value_col, probs).take(1)
    if not row:
        return [None] * len(probs)
    return [row[0][f"q_{i}"] for i in range(len(probs))]


def n_extreme(df: DataFrame, n: int, by: str, largest: bool = True,
              tie_break: Sequence[str] = ()) -> DataFrame:
    """N largest / smallest rows (TakeOrderedAndProject: per-partition top-n, then merge)."""
    o = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    return df.orderBy(o, *[F.col(c).asc() for c in tie_break]).limit(n)


def sort_multi(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Multi-key sort, mixed directions ``[(col, ascending), ...]``."""
    return df.orderBy(*[F.col(c).asc() if a else F.col(c).desc() for c, a in keys])


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """``row_number() <= n`` per group. Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
    ``n`` rows per input partition."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def head_sample(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """First ``n`` rows by key (deterministic export sample)."""
    return df.orderBy(F.col(key).asc()).limit(n)
