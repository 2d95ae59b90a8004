"""Column profiles.

Rule: statistics of many columns are computed in ONE aggregate (or one
sort over an unpivoted long table) and then reshaped with ``stack``/explode,
never one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bins import equal_width_bucket
from ..functions.columns import scalars
from .order import average_rank, exact_quantiles

DEFAULT_PERCENTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.BooleanType)]


def pct_name(p: float) -> str:
    v = round(p * 100, 6)
    return f"p{int(v)}" if float(v).is_integer() else "p" + f"{v:g}".replace(".", "_")


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long ``(keep..., column, value)`` with values as double; nulls kept."""
    st = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                             for c in cols])).alias("_s")
    return df.select(*keep, st).select(*keep, f"_s.{name}", f"_s.{value}")


def sample_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness G1 from the population g1 (rule M2)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurt(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from the population g2 (rule M2)."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (ddof=1), min, max, skew, kurt per column, from one ``agg``."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.skewness(x).alias(f"{c}__g1"),
                 F.kurtosis(x).alias(f"{c}__g2")]
    one = df.agg(*aggs)
    fields = ["count", "mean", "std", "min", "max", "g1", "g2"]
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                      *[F.col(f"{c}__{k}").alias(k) for k in fields]) for c in cols])).alias("s")
    long = one.select(st).select("s.*")
    return (long.withColumn("skew", sample_skew(F.col("g1"), F.col("count")))
            .withColumn("kurt", sample_kurt(F.col("g2"), F.col("count")))
            .drop("g1", "g2"))


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             percentiles: Sequence[float] = DEFAULT_PERCENTILES) -> DataFrame:
    """One row per column: count, mean, std, min, percentiles, max, skew, kurt.
    Percentiles are exact (one range-partitioned sort of the long table for all columns)."""
    cols = list(cols or numeric_columns(df))
    mom = moments(df, cols)
    if not percentiles:
        return mom
    long = unpivot(df.select(*cols), cols)
    q = exact_quantiles(long, "value", percentiles, ["column"])
    q = q.select("column", *[F.col(f"q_{i}").alias(pct_name(p)) for i, p in enumerate(percentiles)])
    return mom.join(q, "column", "left")


def missing_report(df: DataFrame, threshold: float = 0.05, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing, share, over_threshold)`` from one ``agg``; share over all rows."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull() | (F.isnan(F.col(c)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.lit(False))).alias(c) for c in cols])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("missing")) for c in cols])).alias("s")
    out = one.select("__n", st).select("__n", "s.*")
    return (out.withColumn("share", F.col("missing") / F.col("__n"))
            .withColumn("over_threshold", F.col("share") > F.lit(threshold)).drop("__n"))


def value_counts(df: DataFrame, column: str, denominator: str = "non_null") -> DataFrame:
    """``(value, count, share)``; null keys dropped (M6); share over
    non-null rows (``value_counts(normalize=True)``) or all rows (M7)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if denominator == "all":
        total = scalars(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    else:
        total = scalars(df.agg(F.count(column).alias("n")))["n"]
    return counts.withColumn("share", F.col("count") / F.lit(float(total or 0)))


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column q1, q3, iqr, fences, outlier count and its share of the
    column's values (nulls and NaN are none). Exact quartiles of all columns
    together, then one ``agg``."""
    long = unpivot(df.select(*cols), cols)
    q = exact_quantiles(long, "value", [0.25, 0.75], ["column"]).collect()  # one row per column
    fences = {r["column"]: (r["q_0"], r["q_1"]) for r in q}
    aggs = []
    for c in cols:
        q1, q3 = fences[c]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs.append(F.struct(F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias("out"), F.count(x).alias("n")).alias(c))
    one = df.agg(*aggs)
    rows = []
    for c in cols:
        q1, q3 = fences[c]
        iqr = q3 - q1
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"),
                             F.lit(iqr).alias("iqr"), F.lit(q1 - k * iqr).alias("lower"),
                             F.lit(q3 + k * iqr).alias("upper"), F.col(c)["out"].cast("bigint").alias("n_outliers"),
                             F.try_divide(F.col(c)["out"], F.col(c)["n"]).alias("share")))
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def shape_label(skew: Column, kurt: Column, skew_t: float = 0.5, strong_t: float = 1.0,
                kurt_t: float = 1.0) -> tuple[Column, Column]:
    """Text labels for asymmetry and tails from skew/kurtosis thresholds."""
    sk = (F.when(skew.isNull(), None)
          .when(F.abs(skew) < skew_t, F.lit("symmetric"))
          .when(skew >= strong_t, F.lit("strong right skew"))
          .when(skew > 0, F.lit("moderate right skew"))
          .when(skew <= -strong_t, F.lit("strong left skew"))
          .otherwise(F.lit("moderate left skew")))
    ku = (F.when(kurt.isNull(), None)
          .when(kurt > kurt_t, F.lit("heavy tails"))
          .when(kurt < -kurt_t, F.lit("light tails"))
          .otherwise(F.lit("normal tails")))
    return sk, ku


def distribution_shapes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    mom = moments(df, cols)
    sk, ku = shape_label(F.col("skew"), F.col("kurt"))
    return mom.select("column", "skew", "kurt", sk.alias("asymmetry"), ku.alias("tails"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix, long ``(col_a, col_b, r)``; pairwise-complete rows
    (Spark ``corr`` skips rows where either side is null, as pandas). One ``agg``."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs]) \
        if pairs else None
    structs = []
    for a, b in pairs:
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("r")))
        structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"{a}__{b}").alias("r")))
    structs += [F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("r")) for c in cols]
    base = one if one is not None else df.sparkSession.range(1)
    return base.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def spearman_matrix(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Spearman = Pearson over average ranks (Q01). Rows with a null in
    any listed column are dropped first. ``key`` identifies rows."""
    cols = list(cols)
    base = df.select(key, *cols).na.drop(subset=cols)
    ranked = base
    for c in cols:
        r = average_rank(base, c).select(F.col(c), F.col("rank").alias(f"__r_{c}"))
        ranked = ranked.join(r, c, "left")
    ranked = ranked.select(key, *[F.col(f"__r_{c}").alias(c) for c in cols])
    return corr_matrix(ranked, cols)


def target_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Features ranked by |corr(feature, target)|, one ``agg``."""
    feats = [c for c in cols if c != target]
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in feats])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in feats])).alias("s")
    out = one.select(st).select("s.*").withColumn("abs_r", F.abs("r"))
    return out.orderBy(F.col("abs_r").desc(), F.col("feature"))


def histogram(df: DataFrame, column: str, bins: int = 10, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width histogram ``(bin, lower, upper, count)``, all bins present.
    Range from one ``agg`` unless given; empty bins come from ``range(bins)``."""
    if lo is None or hi is None:
        st = scalars(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
        lo = float(st["lo"]) if lo is None else lo
        hi = float(st["hi"]) if hi is None else hi
    width = (hi - lo) / bins if hi > lo else 1.0
    counts = (df.where(F.col(column).isNotNull() & (F.col(column) >= lo) & (F.col(column) <= hi))
              .select(equal_width_bucket(column, lo, hi, bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (F.broadcast(grid).join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def kde_grid(df: DataFrame, column: str, grid_points: int = 200, bins: int = 2048) -> DataFrame:
    """Gaussian kernel density on a grid (Scott bandwidth, ddof=1 std), from
    binned counts: rows -> ``bins`` counts -> ``bins x grid`` terms (both bounded)."""
    st = scalars(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"),
                        F.stddev_samp(column).alias("sd"), F.count(column).alias("n")))
    lo, hi, sd, n = float(st["lo"]), float(st["hi"]), float(st["sd"] or 0.0), int(st["n"])
    h = sd * n ** (-1.0 / 5.0) if sd > 0 else 1.0
    hist = histogram(df, column, bins, lo, hi).where(F.col("count") > 0) \
        .select(((F.col("lower") + F.col("upper")) / 2).alias("c"), "count")
    step = (hi - lo) / (grid_points - 1) if grid_points > 1 else 0.0
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("g")
    terms = hist.select("c", "count", grid).withColumn("x", F.lit(lo) + F.col("g") * F.lit(step))
    dens = terms.groupBy("g", "x").agg(
        (F.sum(F.col("count") * F.exp(-0.5 * F.pow((F.col("x") - F.col("c")) / F.lit(h), 2)))
         / F.lit(n * h * (2 * 3.141592653589793) ** 0.5)).alias("density"))
    return dens.select("x", "density")


def eda_summary(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """One-row summary record from named aggregate expressions."""
    return df.agg(*[e.alias(k) for k, e in exprs.items()])


def box_stats(df: DataFrame, value: str, group_cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per group q1, median, q3, whiskers (most extreme values within
    ``k*IQR``) and outlier count. Quartiles by the range-sort quantile helper."""
    g = list(group_cols)
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], g).select(
        *g, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    base = df.select(*g, value).where(F.col(value).isNotNull())
    for c in g:
        base = base.where(F.col(c).isNotNull())
    j = base.join(q, g)
    lo = F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))
    agg = j.groupBy(*g).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(F.col(value) >= lo, F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= hi, F.col(value))).alias("whisker_high"),
        F.count_if((F.col(value) < lo) | (F.col(value) > hi)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return agg


def group_trend(df: DataFrame, x: str, y: str, group_cols: Sequence[str], min_rows: int = 10) -> DataFrame:
    """Straight-line fit per group (slope, intercept), groups with >= ``min_rows``."""
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"),
                                      F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                                      F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))
            .where(F.col("n") >= min_rows))


def geometric_mean(df: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    """``exp(mean(ln x))`` per group (positive values)."""
    return df.groupBy(*group_cols).agg(F.exp(F.avg(F.ln(F.col(value)))).alias("geo_mean"))
