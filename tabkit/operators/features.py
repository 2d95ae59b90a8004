"""Fitted transformers (V-F01-V-F16) as ``pyspark.ml`` Estimator/Model pairs
or fit/transform functions.

Fitting aggregates the data on executors (one pass where possible, exact
quantiles by range sort); the fitted state is small (per-column or per-group
numbers) and is applied with column arithmetic. Group-level state is joined
back and left to AQE, because the number of groups is not bounded a priori.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import scalars
from .order import exact_quantiles, land, quantile_values


class NotFittedError(RuntimeError):
    pass


# ---------------------------------------------------------------- V-F01 group median imputer

class GroupMedianImputer(Estimator):
    """V-F01: fill nulls of ``cols`` with the median of their ``group`` (exact);
    unseen or all-null groups fall back to the global median."""

    def __init__(self, group: str, cols: Sequence[str]):
        super().__init__()
        self.group, self.cols = group, list(cols)

    def _fit(self, df: DataFrame):
        missing = [c for c in [self.group, *self.cols] if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        from .profile import unpivot
        long = unpivot(df.select(self.group, *self.cols), self.cols, keep=[self.group])
        per = exact_quantiles(long.where(F.col(self.group).isNotNull()), "value", [0.5], [self.group, "column"])
        glob = {r["column"]: r["q_0"] for r in exact_quantiles(long, "value", [0.5], ["column"]).collect()}
        # landed, so that the join knows its size and sends few groups to the rows
        wide = land(per.groupBy(self.group).pivot("column", self.cols).agg(F.first("q_0")), "medians")
        return GroupMedianImputerModel(self.group, self.cols, wide, glob)


class GroupMedianImputerModel(Model):
    def __init__(self, group, cols, medians: DataFrame | None, global_medians: dict | None):
        super().__init__()
        self.group, self.cols, self.medians, self.global_medians = group, cols, medians, global_medians

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.medians is None:
            raise NotFittedError("GroupMedianImputer must be fitted before transform")
        missing = [c for c in [self.group, *self.cols] if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        med = self.medians.select(self.group, *[F.col(c).alias(f"__med_{c}") for c in self.cols])
        j = df.join(med, self.group, "left")
        return j.select(*[F.coalesce(F.col(c), F.col(f"__med_{c}"), F.lit(self.global_medians.get(c))).alias(c)
                          if c in self.cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- V-F02 median imputer

def fit_median_imputer(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict:
    """V-F02: column medians (exact by default; MLlib ``Imputer`` is approximate)."""
    if exact:
        return {c: quantile_values(df, c, [0.5])[0] for c in cols}
    from pyspark.ml.feature import Imputer
    m = Imputer(strategy="median", inputCols=list(cols), outputCols=list(cols)).fit(df)
    row = m.surrogateDF.first()
    return {c: row[c] for c in cols}


def impute(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


# ---------------------------------------------------------------- V-F03 / V-F04 scalers

def fit_zscore(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> DataFrame:
    """V-F03: parameters table ``(column, mean, std)``; missing and zero-variance
    columns are skipped (one aggregate)."""
    present = [c for c in cols if c in df.columns]
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = scalars(df.agg(*[x for c in present for x in (F.avg(c).alias(f"m_{c}"), sd(c).alias(f"s_{c}"))]))
    rows = [(c, float(st[f"m_{c}"]), float(st[f"s_{c}"])) for c in present
            if st[f"s_{c}"] is not None and st[f"s_{c}"] > 0]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, std double")


def apply_affine(df: DataFrame, params: DataFrame, center: str = "mean", scale: str = "std",
                 inverse: bool = False) -> DataFrame:
    """Apply ``(x - center) / scale`` (or its inverse) from a small params table."""
    p = {r["column"]: (r[center], r[scale]) for r in params.collect()}  # one row per column
    new = {}
    for c, (m, s) in p.items():
        if c in df.columns:
            new[c] = (F.col(c) * F.lit(s) + F.lit(m)) if inverse else (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(new)


def fit_minmax(df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """V-F04 min-max (range) scaler as affine params ``x' = (x - c)/s``."""
    st = scalars(df.agg(*[x for c in cols for x in (F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}"))]))
    rows = []
    for c in cols:
        a, b = float(st[f"a_{c}"]), float(st[f"b_{c}"])
        rng = (b - a) if b > a else 1.0
        s = rng / (hi - lo)
        rows.append((c, a - lo * s, s))
    return df.sparkSession.createDataFrame(rows, "column string, mean double, std double")


def fit_robust(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V-F04/M15: robust scaler ``(x - median) / IQR`` with exact quantiles of
    all columns from one sort of the unpivoted table."""
    from .profile import unpivot
    q = exact_quantiles(unpivot(df.select(*cols), cols), "value", [0.25, 0.5, 0.75], ["column"]).collect()
    rows = [(r["column"], float(r["q_1"]), float((r["q_2"] - r["q_0"]) or 1.0)) for r in q]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, std double")


# ---------------------------------------------------------------- V-F05 power transforms

def _yj(x: Column, lam: float) -> Column:
    pos = x >= 0
    if abs(lam) < 1e-12:
        a = F.log1p(x)
    else:
        a = (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
    if abs(lam - 2) < 1e-12:
        b = -F.log1p(-x)
    else:
        b = -(F.pow(-x + 1, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(pos, a).otherwise(b)


def _bc(x: Column, lam: float) -> Column:
    return F.ln(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1) / F.lit(lam)


def fit_power(df: DataFrame, col: str, method: str = "yeo-johnson", lo: float = -2.0, hi: float = 2.0,
              steps: int = 41, refine: int = 2) -> float:
    """V-F05: lambda maximising the profile log-likelihood, searched on a grid
    evaluated in ONE aggregate per round (sum and sum of squares of every
    candidate transform), then refined around the best value."""
    x = F.col(col).cast("double")
    base = df.where(x.isNotNull())
    if method == "box-cox":
        base = base.where(x > 0)
    n, slog = None, None
    best = None
    for _ in range(refine + 1):
        grid = list(np.linspace(lo, hi, steps))
        tf = _yj if method == "yeo-johnson" else _bc
        aggs = [F.count(F.lit(1)).alias("n")]
        if method == "yeo-johnson":
            aggs.append(F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("slog"))
        else:
            aggs.append(F.sum(F.ln(x)).alias("slog"))
        for i, lam in enumerate(grid):
            y = tf(x, float(lam))
            aggs += [F.sum(y).alias(f"s{i}"), F.sum(y * y).alias(f"q{i}")]
        st = scalars(base.agg(*aggs))
        n, slog = float(st["n"]), float(st["slog"])
        llf = []
        for i, lam in enumerate(grid):
            m = st[f"s{i}"] / n
            var = st[f"q{i}"] / n - m * m
            if var is None or var <= 0 or math.isnan(var):
                llf.append(-math.inf)
                continue
            llf.append(-n / 2 * math.log(var) + (lam - 1) * slog)
        k = int(np.argmax(llf))
        best = float(grid[k])
        step = (hi - lo) / (steps - 1)
        lo, hi = best - step, best + step
    return best


def apply_power(df: DataFrame, col: str, lam: float, method: str = "yeo-johnson", out: str | None = None,
                standardize: bool = True) -> DataFrame:
    x = F.col(col).cast("double")
    y = _yj(x, lam) if method == "yeo-johnson" else _bc(x, lam)
    o = out or f"{col}_pt"
    res = df.withColumn(o, y)
    if standardize:
        st = scalars(res.agg(F.avg(o).alias("m"), F.stddev_pop(o).alias("s")))
        res = res.withColumn(o, (F.col(o) - F.lit(st["m"])) / F.lit(st["s"]))
    return res


# ---------------------------------------------------------------- V-F09 stateless pipeline

def stateless_pipeline(df: DataFrame, config: dict) -> DataFrame:
    """V-F09: flags -> ratios -> logs -> distances -> polynomials -> encoding ->
    selection, in this fixed order, from a config dict. Catalyst collapses the
    steps into one projection."""
    from ..functions import columns as C
    out = df
    if config.get("binary_flags"):
        out = C.binary_flags(out, config["binary_flags"])
    if config.get("ratios"):
        out = C.ratio_features(out, config["ratios"])
    if config.get("logs"):
        out = C.log_features(out, config["logs"])
    if config.get("distances"):
        d = config["distances"]
        out = C.point_distances(out, d["x"], d["y"], d["points"], nearest_name=d.get("nearest"))
    if config.get("polynomial"):
        out = C.polynomial_features(out, config["polynomial"])
    for spec in config.get("ordinal", []):
        out = C.ordinal_map(out, spec["column"], spec["mapping"], out=spec.get("out"))
    for spec in config.get("one_hot", []):
        out = C.one_hot(out, spec["column"], spec["values"], prefix=spec.get("prefix"), drop_first=spec.get("drop_first", False))
    if config.get("select"):
        out = C.select_features(out, config["select"], fill_missing=config.get("fill_missing"))
    return out


# ---------------------------------------------------------------- V-F13..V-F16 projections

def pca_tables(df: DataFrame, features: str, k: int, scale: bool = True):
    """V-F13: ``(fitted PCA model, explained-variance table, loadings table)``.
    Signs fixed so each component's largest-|loading| is positive."""
    from pyspark.ml.feature import PCA, StandardScaler
    data = df
    if scale:
        data = StandardScaler(inputCol=features, outputCol="_scaled", withMean=True, withStd=True).fit(df).transform(df)
        features = "_scaled"
    model = PCA(k=k, inputCol=features, outputCol="pca").fit(data)
    pc = model.pc.toArray()
    signs = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])])
    pc = pc * signs
    ev = model.explainedVariance.toArray()
    spark = df.sparkSession
    var = spark.createDataFrame([(i + 1, float(v), float(np.cumsum(ev)[i])) for i, v in enumerate(ev)],
                                "component int, explained_variance double, cumulative double")
    load = spark.createDataFrame([(int(j), int(i + 1), float(pc[j, i])) for j in range(pc.shape[0]) for i in range(pc.shape[1])],
                                 "feature int, component int, loading double")
    return model, var, load, signs


def components_for_share(var_table: DataFrame, share: float) -> int:
    """V-F13: smallest k whose cumulative explained variance reaches ``share``."""
    r = var_table.where(F.col("cumulative") >= share).agg(F.min("component")).first()[0]
    return int(r) if r is not None else var_table.count()


def random_fourier(df: DataFrame, col: str, dim_in: int, dim_out: int = 100, gamma: float = 1.0,
                   seed: int = 7, out: str = "rff") -> DataFrame:
    """V-F14: random Fourier features ``sqrt(2/D) cos(Wx + b)`` (RBF kernel
    ``exp(-gamma |x-y|^2)``), W ~ N(0, 2 gamma), computed per Arrow batch with
    numpy (the D x d weight matrix is the only shipped state)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(dim_in, dim_out))
    b = rng.uniform(0, 2 * math.pi, size=dim_out)
    scale = math.sqrt(2.0 / dim_out)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(v: pd.Series) -> pd.Series:
        x = np.stack(v.apply(lambda a: np.asarray(a, dtype=float)).values)
        z = scale * np.cos(x @ w + b)
        return pd.Series(list(z))

    return df.withColumn(out, rff(F.col(col)))


def lda_projection(df: DataFrame, col: str, label: str, k: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """V-F15: Fisher discriminant directions. Class means come from one grouped
    ``Summarizer`` pass; the total covariance from ``Correlation`` and
    ``Summarizer.variance`` (JVM-side tree aggregates, no per-row Python); the
    pooled within-class scatter is ``S_w = (n-1) Cov_total - S_b`` with
    ``S_b = sum_c n_c (mu_c - mu)(mu_c - mu)^T``. Only d x d matrices and k
    class means reach the driver, which solves the small eigenproblem."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation, Summarizer
    vec = df.select(label, array_to_vector(F.col(col).cast("array<double>")).alias("v"))
    means = vec.groupBy(label).agg(Summarizer.mean(F.col("v")).alias("m"), F.count(F.lit(1)).alias("n")).collect()
    mu = {r[label]: r["m"].toArray() for r in means}
    ns = {r[label]: r["n"] for r in means}
    n = sum(ns.values())
    gm = sum(ns[c] * mu[c] for c in mu) / n
    d = len(gm)
    sb = sum(ns[c] * np.outer(mu[c] - gm, mu[c] - gm) for c in mu)
    corr = np.nan_to_num(Correlation.corr(vec, "v").first()[0].toArray())
    var = vec.select(Summarizer.variance(F.col("v")).alias("s")).first()["s"].toArray()
    sd = np.sqrt(var)
    sw = (n - 1) * (corr * np.outer(sd, sd)) - sb
    evals, evecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
    order = np.argsort(-evals.real)
    kk = k or min(len(mu) - 1, d)
    wb = evecs[:, order[:kk]].real.tolist()

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(v: pd.Series) -> pd.Series:
        x = np.stack(v.apply(lambda a: np.asarray(a, dtype=float)).values)
        return pd.Series(list(x @ np.asarray(wb)))

    return df.withColumn("lda", project(F.col(col))), evals.real[order[:kk]]


def tfidf_svd(tfidf_long: DataFrame, key: str, k: int = 2) -> DataFrame:
    """V-F16: truncated SVD of the sparse TF-IDF matrix (``IndexedRowMatrix.computeSVD``
    on sparse rows, no densifying), rows of U*S L2-normalised. The weights and the
    rows are landed: the solver reads the rows again in each of its passes."""
    from pyspark.mllib.linalg import Vectors as MV
    from pyspark.mllib.linalg import VectorUDT
    from pyspark.mllib.linalg.distributed import IndexedRowMatrix
    # dense term index 0..V-1 without a global window: rank via the prefix-sum helper
    from .order import row_positions
    weights = land(tfidf_long.select(key, "term", "weight"), "weights")
    vocab = row_positions(weights.select("term").distinct(), ["term"]).select("term", (F.col("pos") - 1).cast("int").alias("idx"))
    nterms = vocab.count()
    sparse = F.udf(lambda idx, w: MV.sparse(nterms, idx, w), VectorUDT())
    rows = (weights.join(vocab, "term").groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("e")))
    rows = land(rows.select(F.col(key).cast("long").alias("index"), sparse("e.idx", "e.weight").alias("vector")), "rows")
    svd = IndexedRowMatrix(rows, 0, nterms).computeSVD(k, computeU=True)
    s = svd.s.toArray()
    u = svd.U.rows.map(lambda r: (int(r.index), [float(v) for v in (r.vector.toArray() * s)]))
    out = df_from_rdd(tfidf_long.sparkSession, u, key)
    norm = F.sqrt(F.aggregate(F.col("svd"), F.lit(0.0), lambda a, x: a + x * x))
    return out.withColumn("svd", F.transform("svd", lambda x: x / norm))


def df_from_rdd(spark, rdd, key):
    return spark.createDataFrame(rdd, f"{key} long, svd array<double>")
