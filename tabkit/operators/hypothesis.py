"""Hypothesis tests (H01-H17): statistics on executors, tails from ``dist``.

Rank tests collapse the data to ``(value, group, count)`` first and rank the
distinct values with the range-partitioned prefix sum, so a value or a group
holding a third of the rows is a single aggregated row, not a hot task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist as DI
from ..functions.columns import scalars
from .order import exact_quantiles, value_positions, row_positions


def _clean(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    out = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return out.where(F.col(group).isNotNull()) if group else out


# ---------------------------------------------------------------- normality

def dagostino_k2(df: DataFrame, value: str) -> DataFrame:
    """D'Agostino-Pearson K^2 = Z(skew)^2 + Z(kurtosis)^2, p = exp(-K^2/2)."""
    x = F.col(value).cast("double")
    m = _clean(df, value).agg(F.count(x).cast("double").alias("n"), F.skewness(x).alias("g1"),
                              F.kurtosis(x).alias("g2"))
    n, b1, b2 = F.col("n"), F.col("g1"), F.col("g2") + F.lit(3.0)
    # skew test
    y = b1 * F.sqrt((n + 1) * (n + 3) / (F.lit(6.0) * (n - 2)))
    beta2 = F.lit(3.0) * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + F.sqrt(F.lit(2.0) * (beta2 - 1))
    delta = F.lit(1.0) / F.sqrt(F.lit(0.5) * F.ln(w2))
    alpha = F.sqrt(F.lit(2.0) / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    zs = delta * F.ln(y / alpha + F.sqrt(F.pow(y / alpha, 2) + 1))
    # kurtosis test
    e = F.lit(3.0) * (n - 1) / (n + 1)
    varb2 = F.lit(24.0) * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    xk = (b2 - e) / F.sqrt(varb2)
    sb1 = F.lit(6.0) * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(F.lit(6.0) * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = F.lit(6.0) + F.lit(8.0) / sb1 * (F.lit(2.0) / sb1 + F.sqrt(F.lit(1.0) + F.lit(4.0) / (sb1 * sb1)))
    term1 = F.lit(1.0) - F.lit(2.0) / (F.lit(9.0) * a)
    den = F.lit(1.0) + xk * F.sqrt(F.lit(2.0) / (a - 4))
    term2 = F.signum(den) * F.pow((F.lit(1.0) - F.lit(2.0) / a) / F.abs(den), F.lit(1.0 / 3.0))
    zk = (term1 - term2) / F.sqrt(F.lit(2.0) / (F.lit(9.0) * a))
    out = m.select(F.col("n").cast("long").alias("n"), zs.alias("z_skew"), zk.alias("z_kurt"))
    k2 = F.col("z_skew") ** 2 + F.col("z_kurt") ** 2
    return out.withColumn("k2", k2).withColumn("p_value", F.exp(-k2 / 2))


def anderson_darling(df: DataFrame, value: str, key_cols: Sequence[str]) -> DataFrame:
    """A^2 for normality with estimated mean/std (ddof=1) and the 5 %
    critical value. Each row needs only its position i in the sorted order:
    sum_i (2i-1) [ln F(z_i) + ln(1 - F(z_{n+1-i}))] is regrouped per row."""
    base = _clean(df, value)
    st = scalars(base.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.stddev_samp(value).alias("s")))
    n, m, s = int(st["n"]), float(st["m"]), float(st["s"])
    pos = row_positions(base.select(value, *key_cols), [value, *key_cols])
    z = (F.col(value) - F.lit(m)) / F.lit(s)
    i = F.col("pos").cast("double")
    term = ((F.lit(2.0) * i - 1) * DI.norm_logcdf_col(z)
            + (F.lit(2.0) * (F.lit(n + 1.0) - i) - 1) * DI.norm_logcdf_col(-z))
    a2 = pos.agg((F.lit(-float(n)) - F.sum(term) / F.lit(float(n))).alias("a2"))
    crit = 0.787 / (1 + 4.0 / n - 25.0 / (n * n))
    return a2.select(F.lit(n).cast("long").alias("n"), "a2", F.lit(crit).alias("critical_5pct"),
                     (F.col("a2") > F.lit(crit)).alias("reject_5pct"))


def ks_normality(df: DataFrame, value: str) -> DataFrame:
    """Kolmogorov-Smirnov against the normal with estimated mean/std
    (``ml.stat.KolmogorovSmirnovTest``; no row cap, unlike Shapiro-Wilk)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    base = _clean(df, value).select(F.col(value).cast("double").alias(value))
    st = scalars(base.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s")))
    res = KolmogorovSmirnovTest.test(base, value, "norm", float(st["m"]), float(st["s"]))
    return res.select(F.col("statistic").alias("ks"), F.col("pValue").alias("p_value"))


# ---------------------------------------------------------------- group comparisons

def group_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    x = F.col(value).cast("double")
    return _clean(df, value, group).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"))


def with_p_value(stats: DataFrame, kind: str, *cols: str) -> DataFrame:
    """Adds ``p_value`` (null where the statistic is not a number) and
    ``significance`` to a table of statistics: a row a test, never data rows."""
    p = DI.pvalue_udf(kind)(*[F.col(c).cast("double") for c in cols])
    out = stats.withColumn("p_value", F.nanvl(p, F.lit(None).cast("double")))
    return out.withColumn("significance", significance(F.col("p_value")))


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """F = (SSB/(k-1)) / (SSW/(N-k)) from per-group n, mean, variance;
    also eta^2 = SSB/(SSB+SSW) (H13)."""
    g = group_moments(df, value, group)
    tot = g.agg(F.sum("n").alias("N"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("gm"),
                F.count(F.lit(1)).alias("k"))
    st = scalars(tot)
    N, gm, k = float(st["N"]), float(st["gm"]), int(st["k"])
    ss = g.agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.lit(gm), 2)).alias("ssb"),
               F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"))
    return ss.select(F.lit(k - 1).cast("long").alias("df_between"), F.lit(int(N) - k).cast("long").alias("df_within"),
                     "ssb", "ssw",
                     ((F.col("ssb") / F.lit(k - 1.0)) / (F.col("ssw") / F.lit(N - k))).alias("f"),
                     (F.col("ssb") / (F.col("ssb") + F.col("ssw"))).alias("eta2")).transform(
        with_p_value, "f", "f", "df_between", "df_within")


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """H with tie correction, from ranks of distinct values."""
    base = _clean(df, value, group)
    cells = base.groupBy(value, group).agg(F.count(F.lit(1)).alias("c"))
    pos = value_positions(base, value).select(value, "n", ((F.col("pos_start") + F.col("pos_end")) / 2.0).alias("rank"))
    rs = cells.join(pos, value).groupBy(group).agg(F.sum("c").alias("n_g"), F.sum(F.col("c") * F.col("rank")).alias("r_g"))
    ties = pos.agg(F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("t"), F.sum("n").alias("N"))
    st = scalars(ties)
    N, T = float(st["N"]), float(st["t"])
    h = rs.agg(F.count(F.lit(1)).alias("k"),
               (F.lit(12.0 / (N * (N + 1))) * F.sum(F.col("r_g") * F.col("r_g") / F.col("n_g")) - F.lit(3 * (N + 1))).alias("h_raw"))
    c = 1 - T / (N ** 3 - N) if N > 1 else 1.0
    out = h.select((F.col("k") - 1).cast("long").alias("df"), (F.col("h_raw") / F.lit(c)).alias("h"))
    return with_p_value(out, "chi2", "h", "df")


def levene_median(df: DataFrame, value: str, group: str) -> DataFrame:
    """Levene (Brown-Forsythe, median centre) = ANOVA F on |x - median_g|."""
    base = _clean(df, value, group)
    med = exact_quantiles(base, value, [0.5], [group]).withColumnRenamed("q_0", "_med")
    dev = base.join(med, group).select(group, F.abs(F.col(value) - F.col("_med")).alias("_dev"))
    a = anova_oneway(dev, "_dev", group)
    return a.select("df_between", "df_within", F.col("f").alias("w"), "p_value", "significance")


def mann_whitney(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Two-sided Mann-Whitney U (asymptotic, continuity and tie
    correction), U of the first sample, z, p (normal tail), both medians."""
    base = _clean(df, value, group).where(F.col(group).isin(a, b))
    cells = base.groupBy(value).agg(F.count_if(F.col(group) == F.lit(a)).alias("c1"), F.count(F.lit(1)).alias("c"))
    pos = value_positions(base, value).select(value, ((F.col("pos_start") + F.col("pos_end")) / 2.0).alias("rank"))
    j = cells.join(pos, value)
    st = scalars(j.agg(F.sum("c1").alias("n1"), F.sum("c").alias("N"), F.sum(F.col("c1") * F.col("rank")).alias("r1"),
                       F.sum(F.pow(F.col("c").cast("double"), 3) - F.col("c")).alias("t")))
    n1, N = float(st["n1"]), float(st["N"])
    n2 = N - n1
    u1 = float(st["r1"]) - n1 * (n1 + 1) / 2
    u = max(u1, n1 * n2 - u1)
    sigma = math.sqrt(n1 * n2 / 12.0 * ((N + 1) - float(st["t"]) / (N * (N - 1))))
    z = (u - n1 * n2 / 2.0 - 0.5) / sigma if sigma > 0 else float("nan")
    meds = exact_quantiles(base, value, [0.5], [group])
    m = {r[group]: r["q_0"] for r in meds.collect()}  # two rows
    spark = df.sparkSession
    out = spark.createDataFrame([(int(n1), int(n2), u1, z, m.get(a), m.get(b))],
                                "n1 long, n2 long, u double, z double, median_a double, median_b double")
    return out.withColumn("p_value", F.lit(2.0) * DI.norm_sf_col(F.col("z")))


def spearman_r(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, r): rank correlation of two columns over the rows that have both, from
    distinct pairs with their counts, so a value that holds a third of the rows
    is a handful of pairs. r is null where a column is constant."""
    rows = _clean(_clean(df.select(a, b), a), b)
    pairs = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("_c"))
    for c in (a, b):
        rank = value_positions(rows, c).select(c, ((F.col("pos_start") + F.col("pos_end")) / 2.0).alias(f"_r_{c}"))
        pairs = pairs.join(rank, c)
    # ranks have mean (n + 1) / 2
    n = F.col("_n")
    total = scalars(pairs.agg(F.sum("_c").alias("n")))["n"] or 0
    da, db = (F.col(f"_r_{c}") - F.lit((total + 1) / 2.0) for c in (a, b))
    st = pairs.agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * da * db).alias("ab"), F.sum(F.col("_c") * da * da).alias("aa"),
                   F.sum(F.col("_c") * db * db).alias("bb"))
    return st.select(F.coalesce(n, F.lit(0)).cast("long").alias("n"),
                     (F.col("ab") / F.nullif(F.sqrt(F.col("aa") * F.col("bb")), F.lit(0.0))).alias("r"))


def correlation_tests(df: DataFrame, target: str, cols: Sequence[str], methods: Sequence[str] = ("pearson", "spearman")) -> DataFrame:
    """Per feature and method the correlation with the target over the rows
    that have both: feature, method, n, r, t, p_value, significance (two-sided,
    Student's t with n - 2 degrees). Null where a column is constant or n < 3."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    parts = []
    if "pearson" in methods:
        def pearson(c):
            x, y = (F.when((number(c) + number(target)).isNotNull(), number(k)) for k in (c, target))
            spread = F.sqrt(F.var_pop(x) * F.var_pop(y))
            return F.struct(F.lit(c).alias("feature"), F.lit("pearson").alias("method"), F.count(x).alias("n"),
                            (F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))).alias("r")).alias(c)
        one = df.agg(*[pearson(c) for c in cols])
        parts.append(one.select(F.explode(F.array(*cols)).alias("s")).select("s.*"))
    if "spearman" in methods:
        parts += [spearman_r(df, c, target).select(F.lit(c).alias("feature"), F.lit("spearman").alias("method"), "n", "r") for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    free = F.col("n") - 2
    t = F.when(free > 0, F.when(F.abs("r") < 1, F.col("r") * F.sqrt(free / (F.lit(1.0) - F.col("r") * F.col("r"))))
               .when(F.abs("r") >= 1, F.signum("r") * F.lit(float("inf"))))
    return with_p_value(out.withColumn("t", t).withColumn("_free", free), "t2", "t", "_free").drop("_free")


def chi2_independence(df: DataFrame, a: str, b: str, yates: bool = True, eps: float = 0.0) -> DataFrame:
    """Chi-squared of the a x b contingency table (empty cells included in
    closed form: their total expected count is N - sum of non-empty expected),
    Yates correction when dof = 1 (rule M11), Cramér's V (rule M12)."""
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = base.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy(a).agg(F.sum("o").alias("ra"))
    rb = cells.groupBy(b).agg(F.sum("o").alias("rb"))
    st = scalars(cells.agg(F.sum("o").alias("N"), F.count_distinct(a).alias("r"), F.count_distinct(b).alias("k")))
    N, r, k = float(st["N"]), int(st["r"]), int(st["k"])
    dof = (r - 1) * (k - 1)
    j = cells.join(ra, a).join(rb, b).withColumn("e", F.col("ra") * F.col("rb") / F.lit(N))
    if dof == 1 and yates:
        # a 2x2 table: 4 cells and 4 margins reach the driver (bounded by dof = 1)
        ca = {row[a]: row["ra"] for row in ra.collect()}
        cb = {row[b]: row["rb"] for row in rb.collect()}
        obs = {(row[a], row[b]): row["o"] for row in cells.collect()}
        total = 0.0
        for va, na in ca.items():
            for vb, nb in cb.items():
                e = na * nb / N
                o = obs.get((va, vb), 0)
                d = e - o
                o_adj = o + min(0.5, abs(d)) * (1 if d > 0 else -1 if d < 0 else 0)
                total += (o_adj - e) ** 2 / e
        chi = df.sparkSession.createDataFrame([(float(total),)], "chi2 double")
    else:
        chi = j.agg((F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")) + (F.lit(N) - F.sum("e"))).alias("chi2"))
    m = min(r, k) - 1
    v = F.sqrt(F.col("chi2") / (F.lit(N * m) + F.lit(eps))) if m > 0 else F.lit(None).cast("double")
    out = chi.select(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.lit(int(N)).cast("long").alias("n"),
                     F.lit(dof).cast("long").alias("dof"), "chi2", v.alias("cramers_v"))
    return with_p_value(out, "chi2", "chi2", "dof")


def cramers_v_pairs(df: DataFrame, cols: Sequence[str], key: str | None = None) -> DataFrame:
    """Cramér's V (no Yates) for all column pairs in ONE aggregation:
    each row emits one ``(pair, a, b)`` record per column pair (a bounded
    k(k-1)/2 expansion), then counts per cell, marginals, closed-form chi^2."""
    cols = list(cols)
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    recs = F.explode(F.array(*[F.struct(F.lit(x).alias("fa"), F.lit(y).alias("fb"),
                                        F.col(x).cast("string").alias("va"), F.col(y).cast("string").alias("vb"))
                               for x, y in pairs])).alias("r")
    long = df.select(recs).select("r.*").where(F.col("va").isNotNull() & F.col("vb").isNotNull())
    cells = long.groupBy("fa", "fb", "va", "vb").agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy("fa", "fb", "va").agg(F.sum("o").alias("ra"))
    rb = cells.groupBy("fa", "fb", "vb").agg(F.sum("o").alias("rb"))
    tot = cells.groupBy("fa", "fb").agg(F.sum("o").alias("N"), F.count_distinct("va").alias("r"),
                                        F.count_distinct("vb").alias("k"))
    j = cells.join(ra, ["fa", "fb", "va"]).join(rb, ["fa", "fb", "vb"]).join(tot, ["fa", "fb"]) \
        .withColumn("e", F.col("ra") * F.col("rb") / F.col("N"))
    chi = j.groupBy("fa", "fb", "N", "r", "k").agg(
        (F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")) + F.first("N") - F.sum("e")).alias("chi2"))
    v = F.sqrt(F.col("chi2") / (F.col("N") * (F.least("r", "k") - 1)))
    return chi.select(F.col("fa").alias("feature_a"), F.col("fb").alias("feature_b"), "chi2",
                      F.when(F.least("r", "k") > 1, v).alias("cramers_v"))


def signal_label(v: Column, threshold: float = 0.15) -> Column:
    """Strength label of a Cramér's V."""
    return (F.when(v.isNull(), F.lit("none")).when(v >= F.lit(threshold), F.lit("strong"))
            .when(v >= F.lit(threshold / 2), F.lit("moderate")).otherwise(F.lit("weak")))


def encoder_advice(cardinality: Column, max_onehot: int = 12) -> Column:
    """Encoder suggestion from the number of categories."""
    return F.when(cardinality <= F.lit(2), F.lit("binary")).when(cardinality <= F.lit(max_onehot), F.lit("one-hot")) \
        .otherwise(F.lit("frequency/target"))


def tukey_hsd(df: DataFrame, value: str, group: str) -> DataFrame:
    """All group pairs: mean difference, q, adjusted p (studentized range
    on the driver: one number per pair of the <= k^2 pair table), 95 % interval."""
    g = group_moments(df, value, group).collect()  # one row per group
    k = len(g)
    N = sum(r["n"] for r in g)
    mse = sum((r["n"] - 1) * (r["var"] or 0.0) for r in g) / (N - k)
    rows = []
    gs = sorted(g, key=lambda r: r[group])
    # critical q for the interval: solve tukey_sf(q) = 0.05 by bisection
    lo, hi = 0.0, 20.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if DI.tukey_sf(mid, k, N - k) > 0.05 else (lo, mid)
    qcrit = (lo + hi) / 2
    for i, a in enumerate(gs):
        for b in gs[i + 1:]:
            se = math.sqrt(mse / 2 * (1 / a["n"] + 1 / b["n"]))
            diff = b["mean"] - a["mean"]
            q = abs(diff) / se
            rows.append((str(a[group]), str(b[group]), diff, q, DI.tukey_sf(q, k, N - k),
                         diff - qcrit * se, diff + qcrit * se))
    return df.sparkSession.createDataFrame(
        rows, "group_a string, group_b string, meandiff double, q double, p_adj double, lower double, upper double")


def cohens_d(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Cohen's d (pooled ddof=1 std) with magnitude label."""
    g = group_moments(df, value, group).where(F.col(group).isin(a, b))
    st = {r[group]: r for r in g.collect()}
    ra, rb = st[a], st[b]
    pooled = math.sqrt(((ra["n"] - 1) * ra["var"] + (rb["n"] - 1) * rb["var"]) / (ra["n"] + rb["n"] - 2))
    d = (ra["mean"] - rb["mean"]) / pooled
    out = df.sparkSession.createDataFrame([(float(d),)], "d double")
    return out.withColumn("magnitude", d_magnitude(F.col("d")))


def d_magnitude(d: Column) -> Column:
    ad = F.abs(d)
    return (F.when(ad < 0.2, F.lit("negligible")).when(ad < 0.5, F.lit("small"))
            .when(ad < 0.8, F.lit("medium")).otherwise(F.lit("large")))


def eta2_magnitude(e: Column) -> Column:
    return (F.when(e < 0.01, F.lit("negligible")).when(e < 0.06, F.lit("small"))
            .when(e < 0.14, F.lit("medium")).otherwise(F.lit("large")))


def mcnemar(df: DataFrame, truth: str, preds: Sequence[str]) -> DataFrame:
    """McNemar with continuity correction for every pair of models, from
    one aggregate of 2x2 discordant counts; p = erfc(sqrt(x/2)) (chi^2, 1 dof)."""
    preds = list(preds)
    pairs = [(x, y) for i, x in enumerate(preds) for y in preds[i + 1:]]
    aggs = []
    for x, y in pairs:
        rx, ry = F.col(x) == F.col(truth), F.col(y) == F.col(truth)
        aggs += [F.count_if(rx & ~ry).alias(f"{x}__{y}__b"), F.count_if(~rx & ry).alias(f"{x}__{y}__c")]
    one = df.where(F.col(truth).isNotNull()).agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(x).alias("model_a"), F.lit(y).alias("model_b"),
                                      F.col(f"{x}__{y}__b").alias("b"), F.col(f"{x}__{y}__c").alias("c"))
                             for x, y in pairs])).alias("s")
    out = one.select(st).select("s.*")
    stat = F.try_divide(F.pow(F.abs(F.col("b") - F.col("c")) - F.lit(1.0), 2), (F.col("b") + F.col("c")).cast("double"))
    return out.withColumn("statistic", stat).withColumn("p_value", DI.erfc_col(F.sqrt(F.col("statistic") / 2)))


def significance(p: Column, alpha: float = 0.05) -> Column:
    """Significance flag text."""
    return F.when(p < F.lit(alpha), F.lit("significant")).otherwise(F.lit("not significant"))


def disagreement_table(df: DataFrame, truth: str, a: str, b: str) -> DataFrame:
    """Per true class, how many rows each model alone got right, both, neither."""
    ra, rb = F.col(a) == F.col(truth), F.col(b) == F.col(truth)
    return df.where(F.col(truth).isNotNull()).groupBy(truth).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ra & rb).alias("both_right"),
        F.count_if(ra & ~rb).alias("only_a"), F.count_if(~ra & rb).alias("only_b"),
        F.count_if(~ra & ~rb).alias("both_wrong"))
