"""Model fit/score wrappers on ``pyspark.ml`` and model-selection tables
(A01-A19, Z01-Z09).

Fitting is MLlib (distributed over executors); only fitted parameters and
metric rows reach the driver. Tables of results are small DataFrames.
"""

from __future__ import annotations

import importlib
import itertools
import math
import random
from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import scalars

# ---------------------------------------------------------------- A01 factory

CATALOGUE = {
    "linear_regression": ("pyspark.ml.regression", "LinearRegression"),
    "ridge": ("pyspark.ml.regression", "LinearRegression", {"elasticNetParam": 0.0, "regParam": 1.0}),
    "lasso": ("pyspark.ml.regression", "LinearRegression", {"elasticNetParam": 1.0, "regParam": 1.0}),
    "decision_tree_regressor": ("pyspark.ml.regression", "DecisionTreeRegressor"),
    "random_forest_regressor": ("tabkit.operators.trees", "BaggedForestRegressor"),
    "gbt_regressor": ("pyspark.ml.regression", "GBTRegressor"),
    "logistic_regression": ("pyspark.ml.classification", "LogisticRegression"),
    "linear_svc": ("pyspark.ml.classification", "LinearSVC"),
    "decision_tree": ("pyspark.ml.classification", "DecisionTreeClassifier"),
    "random_forest": ("pyspark.ml.classification", "RandomForestClassifier"),
    "gbt": ("pyspark.ml.classification", "GBTClassifier"),
    "mlp": ("pyspark.ml.classification", "MultilayerPerceptronClassifier"),
    "naive_bayes": ("pyspark.ml.classification", "NaiveBayes"),
}


def make_estimator(name: str, **params):
    """Estimator from a catalogue name and params; unknown name -> error."""
    if name not in CATALOGUE:
        raise ValueError(f"unknown model: {name}")
    entry = CATALOGUE[name]
    cls = getattr(importlib.import_module(entry[0]), entry[1])
    defaults = dict(entry[2]) if len(entry) > 2 else {}
    defaults.update(params)
    return cls(**defaults)


def one_vs_rest(estimator, parallelism: int = 4):
    """Multi-class wrapper for binary-only estimators (LinearSVC, GBT);
    the per-class fits are submitted ``parallelism`` at a time."""
    from pyspark.ml.classification import OneVsRest
    return OneVsRest(classifier=estimator, parallelism=parallelism)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weights ``n / (k * n_c)`` (sklearn 'balanced') as a column."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    st = scalars(counts.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")))
    w = counts.select(label, (F.lit(float(st["n"])) / (F.lit(float(st["k"])) * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")  # one row per class


# ---------------------------------------------------------------- scoring helpers

def softmax(scores: Column) -> Column:
    """Softmax of an array of scores (stable: max subtracted)."""
    m = F.array_max(scores)
    ex = F.transform(scores, lambda s: F.exp(s - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda e: e / tot)


def argmax(probs: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(probs, F.array_max(probs)) - F.lit(1)).cast("int")


def fuse_override(p_main: Column, p_crit: Column, threshold: float, crit_index: int, k: int) -> Column:
    """A13 override: if the critical-class score >= t the row becomes a one-hot
    on the critical class, else the main probabilities."""
    onehot = F.array(*[F.lit(1.0 if i == crit_index else 0.0) for i in range(k)])
    return F.when(p_crit >= F.lit(float(threshold)), onehot).otherwise(p_main)


def fuse_weighted(probs: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weighted average of probability arrays (weights normalised)."""
    tot = float(sum(weights))
    acc = None
    for p, w in zip(probs, weights):
        term = F.transform(p, _scale(w / tot))
        acc = term if acc is None else F.zip_with(acc, term, lambda a, b: a + b)
    return acc


def weighted_average(preds: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weighted mean of prediction columns of the same rows (weights normalised)."""
    tot = float(sum(weights))
    acc = None
    for p, w in zip(preds, weights):
        term = p * F.lit(w / tot)
        acc = term if acc is None else acc + term
    return acc


def _scale(w: float):
    return lambda x: x * F.lit(w)


def decision_rule(probs: Column, crit_index: int, threshold: float) -> Column:
    """Critical if its score >= t, else the best of the other classes."""
    others = F.transform(probs, lambda p, i: F.when(i == F.lit(crit_index), F.lit(-1.0)).otherwise(p))
    return F.when(F.element_at(probs, crit_index + 1) >= F.lit(float(threshold)), F.lit(crit_index)) \
        .otherwise(argmax(others))


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """A10: the most frequent class (ties: smallest label) as a constant prediction."""
    mode = (df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.col("_n").desc(), F.col(label)).first()[label])
    return df.withColumn("prediction", F.lit(mode))


def profit_per_row(tp: Column, fn: Column, tn: Column, fp: Column,
                   gains: tuple[float, float, float, float] = (50.0, -5.0, -5.0, -150.0)) -> Column:
    """Average profit ``(50 TP - 5 FN - 5 TN - 150 FP) / N``."""
    g_tp, g_fn, g_tn, g_fp = gains
    n = tp + fn + tn + fp
    return (F.lit(g_tp) * tp + F.lit(g_fn) * fn + F.lit(g_tn) * tn + F.lit(g_fp) * fp) / n


def residual_histogram(df: DataFrame, e: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of residuals with the cumulative share."""
    from .profile import histogram
    h = histogram(df, e, bins)
    n = scalars(h.agg(F.sum("count").alias("n")))["n"]
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= bins rows
    return h.withColumn("cum_share", F.sum("count").over(w) / F.lit(float(n)))


def pipeline_spec(signal: DataFrame) -> DataFrame:
    """One spec row per categorical feature from the signal table (H10),
    plus fixed rows for the text and date columns."""
    spark = signal.sparkSession
    cat = signal.select("feature", F.lit("categorical").alias("type"), F.col("encoder").alias("transformer"),
                        F.col("strength").alias("reason"),
                        F.when(F.col("strength") == "strong", 1).when(F.col("strength") == "moderate", 2)
                        .otherwise(3).alias("priority"))
    fixed = spark.createDataFrame([("text", "text", "tfidf", "free text", 1),
                                   ("o_orderdate", "datetime", "cyclic hour/month", "seasonality", 2)],
                                  "feature string, type string, transformer string, reason string, priority int")
    return cat.unionByName(fixed)


# ---------------------------------------------------------------- CV tables (Z)

def kfold_unit_price_metrics(f: DataFrame) -> DataFrame:
    """Leak-free k-fold evaluation of the unit-price predictor: each fold
    is scored with the mean unit price of the other folds (fold sums subtracted
    from the total), then V01 metrics per fold."""
    from .metrics import regression_metrics
    up = f.withColumn("up", F.col("l_extendedprice") / F.col("l_quantity"))
    tot = scalars(up.agg(F.sum("up").alias("s"), F.count(F.lit(1)).alias("c")))
    fs = up.groupBy("fold").agg(F.sum("up").alias("fs"), F.count(F.lit(1)).alias("fc"))
    p = up.join(F.broadcast(fs), "fold").withColumn(  # one row per fold
        "p", F.col("l_quantity") * (F.lit(tot["s"]) - F.col("fs")) / (F.lit(tot["c"]) - F.col("fc")))
    return regression_metrics(p, "l_extendedprice", "p", ["fold"])


def fold_summary(folds: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric mean, std (ddof=1; null for one fold), coefficient of
    variation and a 95 % interval with the ddof=0 std."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}__mean"), F.stddev_samp(m).alias(f"{m}__std"),
                 F.stddev_pop(m).alias(f"{m}__stdp"), F.count(m).alias(f"{m}__n")]
    one = folds.agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}__mean").alias("mean"),
                                      F.col(f"{m}__std").alias("std"), F.col(f"{m}__stdp").alias("stdp"),
                                      F.col(f"{m}__n").alias("n")) for m in metrics])).alias("s")
    out = one.select(st).select("s.*")
    half = F.lit(1.96) * F.col("stdp") / F.sqrt(F.col("n"))
    return out.select("metric", "mean", "std", (F.col("std") / F.col("mean")).alias("cv"),
                      (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def candidate_cv(f: DataFrame) -> DataFrame:
    """Z06 input: CV RMSE of two candidate predictors (global and per-part
    unit price, both fitted without the scored fold)."""
    from .order import land
    up = land(f.select("l_partkey", "fold", "l_quantity", "l_extendedprice")
              .withColumn("up", F.col("l_extendedprice") / F.col("l_quantity")), "unit_prices")
    pfs = land(up.groupBy("l_partkey", "fold").agg(F.sum("up").alias("pfs"), F.count(F.lit(1)).alias("pfc")), "part_folds")
    tot = scalars(pfs.agg(F.sum("pfs").alias("s"), F.coalesce(F.sum("pfc"), F.lit(0)).alias("c")))
    fs = pfs.groupBy("fold").agg(F.sum("pfs").alias("fs"), F.sum("pfc").alias("fc"))
    ps = pfs.groupBy("l_partkey").agg(F.sum("pfs").alias("ps"), F.sum("pfc").alias("pc"))
    base = (F.lit(tot["s"]) - F.col("fs")) / (F.lit(tot["c"]) - F.col("fc"))
    part = F.when(F.col("pc") - F.col("pfc") > 0, (F.col("ps") - F.col("pfs")) / (F.col("pc") - F.col("pfc"))).otherwise(base)
    # the prices of a part and fold meet the rows in one join
    prices = pfs.join(ps, "l_partkey").join(F.broadcast(fs), "fold").select(
        "l_partkey", "fold", base.alias("u_base"), part.alias("u_part"))
    j = up.join(prices, ["l_partkey", "fold"])
    j = j.withColumn("p_base", F.col("l_quantity") * F.col("u_base")).withColumn("p_part", F.col("l_quantity") * F.col("u_part"))
    per = j.groupBy("fold").agg(F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("p_base"), 2))).alias("baseline"),
                                F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("p_part"), 2))).alias("per_part"))
    avg = per.agg(F.avg("baseline").alias("baseline"), F.avg("per_part").alias("per_part"))
    st = F.explode(F.array(F.struct(F.lit("baseline").alias("model"), F.col("baseline").alias("cv_rmse")),
                           F.struct(F.lit("per_part").alias("model"), F.col("per_part").alias("cv_rmse")))).alias("s")
    return avg.select(st).select("s.*")


def keep_if_better(res: DataFrame, model: str, score: str, baseline: str) -> DataFrame:
    """Tuned candidates kept only if better (lower) than the baseline;
    rank the kept ones and flag the best (``min_by``)."""
    base = res.where(F.col(model) == baseline).first()[score]
    k = res.withColumn("kept", (F.col(model) == baseline) | (F.col(score) < F.lit(base)))
    w = Window.orderBy(F.when(F.col("kept"), F.col(score)).asc_nulls_last())  # one row per candidate
    k = k.withColumn("rank", F.rank().over(w).cast("int"))
    best = k.where("kept").agg(F.min_by(model, score).alias("b")).first()["b"]
    return k.withColumn("best", F.col(model) == F.lit(best))


def selection_report(df: DataFrame, truth: str, models: Sequence[str], fn_cost: float, fp_cost: float) -> DataFrame:
    """Per model cost and recall, the winner by each, and whether they agree."""
    rows = []
    for m in models:
        rows.append(df.agg(F.lit(m).alias("model"),
                           (F.count_if((F.col(m) == 0) & (F.col(truth) == 1)) * F.lit(fn_cost)
                            + F.count_if((F.col(m) == 1) & (F.col(truth) == 0)) * F.lit(fp_cost)).alias("cost"),
                           (F.count_if((F.col(m) == 1) & (F.col(truth) == 1)) / F.count_if(F.col(truth) == 1)).alias("recall")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    st = out.collect()  # one row per model
    best_cost = min(st, key=lambda r: (r["cost"], r["model"]))["model"]
    best_rec = max(st, key=lambda r: (r["recall"], -ord(r["model"][0])))["model"]
    mc, mr = min(r["cost"] for r in st), max(r["recall"] for r in st)
    return (out.withColumn("best_by_cost", F.col("cost") == F.lit(mc))
            .withColumn("best_by_recall", F.col("recall") == F.lit(mr))
            .withColumn("same_winner", F.lit(best_cost == best_rec)))


def holdout_unit_price_rmse(s: DataFrame) -> float:
    up = s.withColumn("up", F.col("l_extendedprice") / F.col("l_quantity"))
    u = scalars(up.where(F.col("split") == "train").agg(F.avg("up").alias("u")))["u"]
    return scalars(up.where(F.col("split") == "test").agg(
        F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("l_quantity") * F.lit(u), 2))).alias("r")))["r"]


def robustness(cv: float, holdout: float, spark: SparkSession, t1: float = 0.10, t2: float = 0.20) -> DataFrame:
    """Robustness label from the relative CV-holdout gap."""
    out = spark.createDataFrame([(float(cv), float(holdout))], "cv_rmse double, holdout_rmse double")
    gap = F.abs(F.col("holdout_rmse") - F.col("cv_rmse")) / F.col("cv_rmse")
    return out.withColumn("gap", gap).withColumn(
        "robustness", F.when(gap < t1, "robust").when(gap < t2, "moderate").otherwise("overfit risk"))


def tune_threshold(table: DataFrame, precision_floor: float) -> DataFrame:
    """Highest recall among thresholds with precision >= floor; the first
    (smallest) threshold wins ties."""
    return (table.where(F.col("precision") >= F.lit(precision_floor))
            .orderBy(F.col("recall").desc(), F.col("threshold").asc()).limit(1))


# ---------------------------------------------------------------- text model

def fit_text_logistic(df: DataFrame, key: str, text: str, label: str, vocab_size: int = 5000,
                      reg: float = 0.01) -> tuple[DataFrame, float]:
    """Bag-of-words logistic regression (CountVectorizer + LogisticRegression
    fitted by MLlib). Returns the coefficient table ``(term, coef)`` and the intercept."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer
    from ..functions.text import tokens
    base = df.select(key, tokens(text, min_len=1).alias("toks"), F.col(label).cast("double").alias("label"))
    cv = CountVectorizer(inputCol="toks", outputCol="features", vocabSize=vocab_size, minDF=2.0)
    cvm = cv.fit(base)
    lr = LogisticRegression(maxIter=50, regParam=reg).fit(cvm.transform(base))
    vocab = cvm.vocabulary
    coefs = lr.coefficients.toArray().tolist()
    spark = df.sparkSession
    coef = spark.createDataFrame(list(zip(vocab, [float(c) for c in coefs])), "term string, coef double")
    return coef, float(lr.intercept)


# ---------------------------------------------------------------- search

def grid_from_space(space: dict, points: int = 3) -> list[dict]:
    """Search space -> grid: ``{"int": (lo, hi)}`` and ``{"float": (lo, hi)}``
    give the two ends, ``{"log": (lo, hi)}`` three log-spaced points, lists as is."""
    axes = {}
    for name, spec in space.items():
        if isinstance(spec, (list, tuple)) and len(spec) == 3 and spec[0] in ("int", "float", "log"):
            kind, lo, hi = spec
            if kind == "log":
                axes[name] = [float(lo * (hi / lo) ** (i / (points - 1))) for i in range(points)]
            elif kind == "int":
                axes[name] = [int(lo), int(hi)]
            else:
                axes[name] = [float(lo), float(hi)]
        else:
            axes[name] = list(spec)
    keys = sorted(axes)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[axes[k] for k in keys])]


def random_draws(space: dict, n: int, seed: int = 13) -> list[dict]:
    """``n`` random parameter maps from the same space description."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        d = {}
        for name, spec in sorted(space.items()):
            if isinstance(spec, (list, tuple)) and len(spec) == 3 and spec[0] in ("int", "float", "log"):
                kind, lo, hi = spec
                if kind == "int":
                    d[name] = rng.randint(int(lo), int(hi))
                elif kind == "log":
                    d[name] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
                else:
                    d[name] = rng.uniform(lo, hi)
            else:
                d[name] = rng.choice(list(spec))
        out.append(d)
    return out


def param_maps(estimator, maps: list[dict]):
    return [{estimator.getParam(k): v for k, v in m.items()} for m in maps]


class CostEvaluator(Evaluator):
    """Custom scorer: expected cost (lower is better) of a binary decision
    ``prediction`` vs ``label`` with per-error unit costs."""

    def __init__(self, fn_cost: float = 10.0, fp_cost: float = 1.0, labelCol: str = "label",
                 predictionCol: str = "prediction"):
        super().__init__()
        self.fn_cost, self.fp_cost = fn_cost, fp_cost
        self.labelCol, self.predictionCol = labelCol, predictionCol

    def _evaluate(self, dataset):
        y, p = F.col(self.labelCol), F.col(self.predictionCol)
        r = dataset.agg((F.count_if((p == 0) & (y == 1)) * F.lit(self.fn_cost)
                         + F.count_if((p == 1) & (y == 0)) * F.lit(self.fp_cost)).alias("c"),
                        F.count(F.lit(1)).alias("n")).first()
        return float(r["c"]) / max(int(r["n"]), 1)

    def isLargerBetter(self):
        return False


def cross_validate(estimator, maps: list, df: DataFrame, evaluator, fold_col: str | None = None,
                   folds: int = 3, parallelism: int = 2, seed: int = 13):
    """Cross-validation as a ``CrossValidatorModel``. With a fold column
    (B06) the rows are landed once, and the leading stages of a pipeline that no
    map touches are fitted once a fold, on its training rows only."""
    from pyspark.ml.tuning import CrossValidator
    if not fold_col:
        return CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                              numFolds=folds, parallelism=parallelism, seed=seed).fit(df)
    return _fold_validate(estimator, maps, df, evaluator, fold_col, folds, parallelism)


def _fold_validate(estimator, maps: list, df: DataFrame, evaluator, fold_col: str, folds: int, parallelism: int):
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import CrossValidatorModel

    from .order import land
    rows, fold = land(df, "folds"), F.col(fold_col)
    sizes = {r[0]: r[1] for r in rows.groupBy(F.when(fold.between(0, folds - 1), fold)).count().take(folds + 1)}
    if None in sizes:
        raise ValueError(f"fold column {fold_col}: values must be from 0 to {folds - 1}")
    for k in range(folds):
        if not sizes.get(k) or sizes[k] == sum(sizes.values()):
            raise ValueError(f"fold {k}: no rows to train on or none to validate with")
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    varied = {param.parent for m in maps for param in m}
    cut = next((i for i, stage in enumerate(stages) if stage.uid in varied), len(stages) - 1)
    if not varied <= {stage.uid for stage in stages}:  # a map reaches into a stage
        cut = 0
    lead, tail = Pipeline(stages=stages[:cut]), Pipeline(stages=stages[cut:]) if cut else estimator
    scores = [[0.0] * folds for _ in maps]
    with ThreadPool(max(1, min(parallelism, len(maps)))) as pool:
        for k in range(folds):
            train, held = rows.where(fold != k), rows.where(fold == k)
            fixed = lead.fit(train)
            train, held = fixed.transform(train), fixed.transform(held)

            def score(i, k=k, train=train, held=held):
                scores[i][k] = evaluator.evaluate(tail.fit(train, maps[i]).transform(held, maps[i]))
            pool.map(inheritable_thread_target(df.sparkSession)(score), range(len(maps)))
    means = [sum(s) / folds for s in scores]
    stds = [math.sqrt(sum((x - m) ** 2 for x in s) / folds) for s, m in zip(scores, means)]
    pick = max if evaluator.isLargerBetter() else min
    best = means.index(pick(means))
    return CrossValidatorModel(estimator.fit(rows, maps[best]), means, [], stds)


def cv_results_table(spark: SparkSession, cv_model, maps: list[dict], name: str) -> DataFrame:
    """Parameters and mean/std CV metric per parameter map."""
    rows = []
    stds = list(getattr(cv_model, "stdMetrics", []) or [None] * len(maps))
    for m, avg, sd in zip(maps, cv_model.avgMetrics, stds):
        rows.append((name, str(sorted(m.items())), float(avg), float(sd) if sd is not None else None))
    return spark.createDataFrame(rows, "model string, params string, mean_metric double, std_metric double")


# ---------------------------------------------------------------- A18 / A19

def permutation_importance(model, df: DataFrame, key: str, features: Sequence[str], evaluator,
                           repeats: int = 5, seed: int = 13) -> DataFrame:
    """Drop of the metric when one feature column is shuffled, averaged
    over ``repeats``. A shuffle is a rank join: every row's original position
    (range-partitioned prefix sum over ``key``) is paired with its position in
    a hash order of (key, repeat); the row takes the feature value of the row
    that holds that position. Positions are unique, so every join is balanced.
    Rows are landed with their positions, and once a repeat with the values of
    their donor: the features of a repeat share one join.
    ``key`` must be unique; ``model`` is a fitted PipelineModel that assembles
    the features itself."""
    from .order import land, row_positions
    spark = df.sparkSession
    larger = evaluator.isLargerBetter()
    own, given = list(df.columns), {f: f"_d_{f}" for f in features}
    df = land(row_positions(df, [key]), "positions")
    base = evaluator.evaluate(model.transform(df.select(*own)))
    donor = df.select(F.col("pos").alias("ppos"), *[F.col(f).alias(d) for f, d in given.items()])
    repeated = not df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()
    rows = []
    for r in range(repeats):
        h = df.select(*own, F.xxhash64(F.col(key), F.lit(seed + r)).alias("_h"))
        perm = row_positions(h, ["_h", key], out="ppos")
        dealt = perm.where(F.col(key).isNotNull()).join(donor, "ppos")
        if repeated:  # every row of a key meets every donor of it, as often as the key occurs
            times = df.select(key)
            dealt = df.select(*own).join(dealt.select(key, *given.values()).join(times, key), key)
        dealt = land(dealt.select(*own, *given.values()), "dealt")
        for f in features:
            swapped = dealt.select(*[F.col(given[f]).alias(f) if c == f else F.col(c) for c in own])
            score = evaluator.evaluate(model.transform(swapped))
            rows.append((f, r, float(base - score) if larger else float(score - base)))
    out = spark.createDataFrame(rows, "feature string, repeat int, importance double")
    return out.groupBy("feature").agg(F.avg("importance").alias("mean_importance"),
                                      F.stddev_samp("importance").alias("std_importance"))


def top_coefficients(model, feature_names: Sequence[str], n: int = 5) -> DataFrame:
    """Top-``n`` coefficients by magnitude per class of a fitted
    (multinomial) logistic regression, with feature names. The coefficient
    matrix is classes x features, i.e. model-sized, not data-sized."""
    from .order import top_n_per_group
    cm = model.coefficientMatrix.toArray()
    rows = [(int(c), str(feature_names[j]), float(cm[c, j])) for c in range(cm.shape[0]) for j in range(cm.shape[1])]
    from pyspark.sql import SparkSession
    sp = SparkSession.getActiveSession()
    long = sp.createDataFrame(rows, "class int, feature string, coef double")
    return top_n_per_group(long, ["class"], [F.abs("coef").desc(), F.col("feature")], n, rank_col="rank")
