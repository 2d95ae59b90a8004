"""Regression trees over many rows.

MLlib's trees see a feature only through its at most ``maxBins`` bins, yet pass over
all rows for every level of every tree. Here rows with the same bins in all features
are summed once into cells, and MLlib fits on the cells: number of rows as weight and
mean as label give the same sums of weights and labels in every bin, and the spread
inside a cell is the same share of a node and of its children, so no split, prediction
or importance changes. There are at most ``max_bins`` to the power of the features'
number cells, whatever the number of rows, and few rows a cell only cost time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import scalars
from .order import land, prefix_sum

#: P(X <= k) of a Poisson variable of mean 1, as far as doubles tell it from 1.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
#: Features of more values than MANY are counted in PARTS of about equal shares first.
MANY, PARTS = 10_000, 1_024


def _edges(points: Sequence[float]) -> list[float]:
    """The splits of a Bucketizer that leaves a value equal to a threshold below it, as trees do."""
    return [-math.inf, *[e for e in np.nextafter(points, math.inf).tolist() if e < math.inf], math.inf]


def _held(df: DataFrame, value: str, rows: int, max_bins: int) -> tuple[list, DataFrame]:
    """Parts of a column of very many values: ``(least, largest, rows)`` of those without a
    boundary, and the rows of the others, in which each value must be counted."""
    v = F.col(value)
    points = df.agg(F.percentile_approx(v, [k / PARTS for k in range(1, PARTS)], PARTS * 10)).first()[0]
    parted = Bucketizer(splits=_edges(np.unique(points)), inputCol=value, outputCol="part").transform(df)
    parts = sorted(tuple(r) for r in parted.groupBy("part").agg(F.min(v), F.max(v), F.count(F.lit(1))).collect())  # PARTS at most
    held, before, j, last = set(), 0, 1, -2
    for k, (_, _, _, n) in enumerate(parts):
        while j < max_bins and j * rows < (before + n) * max_bins:
            # boundaries that crowd move on to the values that follow
            held |= set(range(k, k + max_bins + 2)) if k <= last + 1 else {k}
            j, last = j + 1, k
        before += n
    whole = [p[1:] for k, p in enumerate(parts) if k not in held]
    return whole, parted.where(F.col("part").isin([p[0] for k, p in enumerate(parts) if k in held]))


def split_points(df: DataFrame, features: Sequence[str], max_bins: int = 32) -> dict[str, list[float]]:
    """Thresholds between the bins of each feature, by MLlib's rule: all midpoints of
    neighbouring values if there are no more than ``max_bins`` values, else the
    boundaries nearest to equal shares. MLlib counts the values of about 10,000
    sampled rows; here those of all rows count. Of a feature of more than ``MANY``
    values, only those near the boundaries are counted one by one. Null or NaN raises."""
    df = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    st = scalars(df.agg(F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(c).alias(c) for c in df.columns],
                        *[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"{c}_bad") for c in df.columns]))
    rows = st["rows"]
    if not rows:
        raise ValueError("no rows to fit trees on")
    if bad := [f for i, f in enumerate(features) if st[f"f{i}_bad"]]:
        raise ValueError(f"null or NaN in {bad}")
    counts, whole = [], []
    for i, c in enumerate(df.columns):
        one = df.select(c)
        if st[c] > MANY:
            parts, one = _held(one, c, rows, max_bins)
            whole += [(i, *p) for p in parts]
        counts.append(one.groupBy(c).count().select(F.lit(i).alias("feature"), F.col(c).alias("low"), F.col(c).alias("high"), "count"))
    if whole:
        counts.append(df.sparkSession.createDataFrame(whole, counts[0].schema))
    ranked = land(prefix_sum(reduce(DataFrame.unionAll, counts), ["low"], [None, "count"], ["feature"], ["rank", "upto"]), "values")
    # a boundary is past the share of j bins if the middle of its two running counts is
    past = F.floor((max_bins * (2 * F.col("upto") - F.col("count")) - 1) / F.lit(2 * rows)).cast("int")
    firsts = ranked.groupBy("feature", past.alias("past")).agg(F.min("rank").alias("rank"), F.max("rank").alias("last")).collect()
    picks = []
    for i in range(len(features)):
        own = [r for r in firsts if r["feature"] == i]
        n, at = max(r["last"] for r in own), 1
        if n <= max_bins:
            picks += [(i, r) for r in range(2, n + 1)]
            continue
        for j in range(1, max_bins):
            at = max(at + 1, min((r["rank"] for r in own if r["past"] >= j), default=n + 1))
            if at > n:
                break
            picks.append((i, at))
    ends = {(i, r - k) for i, r in picks for k in (0, 1)}
    near = [F.col("rank").isin([r for f, r in ends if f == i]) & (F.col("feature") == i) for i in range(len(features))]
    found = {(r["feature"], r["rank"]): r for r in ranked.where(reduce(or_, near)).collect()}  # 2 a bin at most
    middles = [(i, (found[i, r - 1]["high"] + found[i, r]["low"]) / 2.0) for i, r in picks]
    return {f: sorted({x for k, x in middles if k == i and x < math.inf}) for i, f in enumerate(features)}


def poisson_ones(rows: np.ndarray, stream: int) -> np.ndarray:
    """One draw of a Poisson variable of mean 1 for each row number: the same for the same
    number and stream, in whatever task it falls (splitmix64, inverse of the distribution)."""
    with np.errstate(over="ignore"):
        z = np.uint64(stream % 2 ** 64) * np.uint64(0xD1342543DE82EF95) + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return np.searchsorted(POISSON, (z >> np.uint64(11)) * 2.0 ** -53, side="right")


def _sum_cells(names: Sequence[str], sizes: Sequence[int], bags: int, seed: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cell, row, y = (b.column(c).to_numpy() for c in ("cell", "row", "label"))
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            n = np.diff(np.r_[starts, len(cell)])
            mean = np.add.reduceat(y, starts) / n
            code, out = cell[starts], []
            for size in sizes:
                out.append((code % size).astype("float64"))
                code = code // size
            out += [n, mean, np.add.reduceat((y - np.repeat(mean, n)) ** 2, starts)]
            for k in range(bags):
                drawn = poisson_ones(row, seed * 1_000_003 + k)
                times = np.add.reduceat(drawn, starts)
                out += [times.astype("int32"), np.add.reduceat(drawn * y, starts) / np.maximum(times, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=list(names))
    return run


def tree_cells(df: DataFrame, features: Sequence[str], label: str, max_bins: int = 32, bags: int = 0, seed: int = 0) -> DataFrame:
    """The rows summed into landed cells: the features' bin numbers under the features'
    names, ``rows``, the mean ``label``, ``within`` (squares around that mean) and, for
    each bag of a forest, ``bag<k>_rows`` and ``bag<k>_label``: every single row is drawn
    Poisson(1) times, as MLlib's forest does. A cell may come as several rows (of
    neighbouring tasks or batches), which are summed alike.
    Rows are dealt by ranges of (cell, row number): a crowded cell has many tasks.
    Null, NaN or infinite labels raise, as in MLlib; losses but the squared error need rows."""
    y = F.col(label).cast("double")
    if scalars(df.agg(F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))).alias("bad")))["bad"]:
        raise ValueError(f"null, NaN or infinite {label}")
    points = split_points(df, features, max_bins)
    sizes = [len(points[f]) + 1 for f in features]
    if math.prod(sizes) >= 2 ** 63:
        raise ValueError(f"too many bins for cells: {sizes}")
    rows = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)], y.alias("label"),
                     F.monotonically_increasing_id().alias("row"))
    cell, step = F.lit(0).cast("long"), 1
    cut = [i for i, size in enumerate(sizes) if size > 1]
    if cut:  # a value equal to a threshold is below it
        edges = [_edges(points[features[i]]) for i in cut]
        rows = Bucketizer(splitsArray=edges, inputCols=[f"f{i}" for i in cut], outputCols=[f"b{i}" for i in cut]).transform(rows)
    for i in cut:
        cell = cell + F.col(f"b{i}").cast("long") * F.lit(step).cast("long")
        step *= sizes[i]
    names = [*features, "rows", "label", "within", *[f"bag{k}_{c}" for k in range(bags) for c in ("rows", "label")]]
    ddl = ", ".join(f"`{c}` {'long' if c == 'rows' else 'int' if c.endswith('_rows') else 'double'}" for c in names)
    dealt = rows.select(cell.alias("cell"), "row", "label").repartitionByRange("cell", "row").sortWithinPartitions("cell")
    return land(dealt.mapInArrow(_sum_cells(names, sizes, bags, seed), ddl), "cells")


def candidates_param(cells: DataFrame) -> int:
    """``maxBins`` for a fit on cells: MLlib looks for bins in maxBins^2 rows, here in all
    cells. No feature gets more bins than the cells have."""
    return max(32, math.isqrt(cells.count()) + 1)


class BaggedForestRegressor(RandomForestRegressor):
    """MLlib's forest; on cells with bags every tree is fitted on its own bag, so that
    the bootstrap is over rows and not over cells. Other tables go to MLlib as they are."""

    def _fit(self, dataset: DataFrame):
        if "bag0_rows" not in dataset.columns:
            return super()._fit(dataset)
        trees = self.getNumTrees()
        if not self.getBootstrap() or self.getSubsamplingRate() != 1.0 or f"bag{trees - 1}_rows" not in dataset.columns:
            raise ValueError("bags are bootstraps of all rows, one for each tree")
        subset = self.getFeatureSubsetStrategy()
        if subset == "auto":  # of a forest, not of its single trees
            subset = "onethird" if trees > 1 else "all"
        sc = dataset.sparkSession.sparkContext
        fitted = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
        for k in range(trees):
            one = self.copy({self.numTrees: 1, self.bootstrap: False, self.featureSubsetStrategy: subset,
                             self.seed: self.getSeed() + k, self.weightCol: "rows", self.labelCol: "label"})
            bag = dataset.where(F.col(f"bag{k}_rows") > 0).select(
                self.getFeaturesCol(), F.col(f"bag{k}_rows").alias("rows"), F.col(f"bag{k}_label").alias("label"))
            model = one.fit(bag)._java_obj
            fitted[k] = model.trees()[0]
        java = sc._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(self.uid, fitted, model.numFeatures())
        model = self._copyValues(RandomForestRegressionModel(java))
        model._transfer_params_to_java()
        return model
