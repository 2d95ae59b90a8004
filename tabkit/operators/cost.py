"""Cost, recovery and risk tables.

Cost matrices, priors and grids are literal tables of fixed small size
(proven broadcast bound) or literal arrays inside expressions. Row-level
sweeps never repeat data rows per grid point: one aggregate holds one
``count_if`` per grid value, or rows are first collapsed into buckets/blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .order import exact_quantiles

# The reference's class order, annual volume, class priors and
# cost matrix (rows = true class, columns = predicted class, same order).
CLASS_ORDER = ["baixo", "medio", "alto", "critico"]
ANNUAL_RECORDS = 15000
CLASS_PRIORS = {"baixo": 0.40, "medio": 0.35, "alto": 0.18, "critico": 0.07}
COST_MATRIX = {
    "baixo": [0, 2000, 15000, 50000],
    "medio": [80000, 0, 8000, 30000],
    "alto": [650000, 120000, 0, 25000],
    "critico": [3200000, 1800000, 400000, 0],
}


def cost_table(spark: SparkSession, matrix: dict = COST_MATRIX, classes: Sequence[str] = CLASS_ORDER) -> DataFrame:
    """``(true_class, pred_class, unit_cost)``: len(classes)^2 rows."""
    rows = [(t, p, float(matrix[t][j])) for t in classes for j, p in enumerate(classes)]
    return spark.createDataFrame(rows, "true_class string, pred_class string, unit_cost double")


def priors_table(spark: SparkSession, priors: dict = CLASS_PRIORS) -> DataFrame:
    return spark.createDataFrame(list(priors.items()), "true_class string, prior double")


def expected_cost_breakdown(rates: DataFrame, spark: SparkSession, n_annual: int = ANNUAL_RECORDS,
                            matrix: dict = COST_MATRIX, priors: dict = CLASS_PRIORS,
                            model_cols: Sequence[str] = ()) -> DataFrame:
    """Per (model, true, pred) off-diagonal cell:
    ``coef = N * P(true) * rate`` and ``cost = coef * unit_cost``.
    ``rates``: ``(model..., true_class, pred_class, rate)`` (V02 row rates)."""
    costs = F.broadcast(cost_table(spark, matrix))
    pri = F.broadcast(priors_table(spark, priors))
    j = (rates.where(F.col("true_class") != F.col("pred_class"))
         .join(costs, ["true_class", "pred_class"]).join(pri, "true_class"))
    return (j.withColumn("coef", F.lit(float(n_annual)) * F.col("prior") * F.col("rate"))
            .withColumn("cost", F.col("coef") * F.col("unit_cost"))
            .select(*model_cols, "true_class", "pred_class", "rate", "unit_cost", "coef", "cost"))


def expected_annual_cost(breakdown: DataFrame, model_cols: Sequence[str] = ()) -> DataFrame:
    """Sum of the V09 breakdown (per model)."""
    agg = F.sum("cost").alias("eace")
    return breakdown.groupBy(*model_cols).agg(agg) if model_cols else breakdown.agg(agg)


def _cost_rows_literal(matrix: dict, classes: Sequence[str]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in matrix[c]]) for c in classes])


def expected_cost_per_record(probs: Column, matrix: dict = COST_MATRIX, classes: Sequence[str] = CLASS_ORDER,
                             orientation: str = "pred_row") -> tuple[Column, Column]:
    """V10 (rule M18): returns ``(pred_index, cee)``. ``pred_row`` reproduces the
    reference (``p . cost[pred]``); ``true_row`` is ``sum_j p_j cost(true=j, pred)``."""
    # first position of the maximum, as numpy argmax
    pmax = F.array_max(probs)
    pred = (F.array_position(probs, pmax) - F.lit(1)).cast("int")
    rows = _cost_rows_literal(matrix, classes)
    if orientation == "pred_row":
        row = F.element_at(rows, pred + F.lit(1))
    else:
        row = F.transform(rows, lambda r: F.element_at(r, pred + F.lit(1)))
    cee = F.aggregate(F.zip_with(probs, row, lambda p, c: p * c), F.lit(0.0), lambda a, x: a + x)
    return pred.cast("int"), cee


def recover_label(pred: Column, cee: Column, max_cee: float, classes: Sequence[str] = CLASS_ORDER) -> Column:
    """Predicted label when its expected cost is within the limit, else null."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.when(cee <= F.lit(float(max_cee)), F.element_at(names, pred + F.lit(1)))


def recovery_metrics(df: DataFrame, label: str, cee: str, classes: Sequence[str] = CLASS_ORDER) -> DataFrame:
    """One row: totals, recovery rate (%), class mix of recovered rows,
    cost mean/median/max of recovered and mean/min of abstained rows."""
    rec = F.col(label).isNotNull()
    one = df.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(rec).alias("n_recovered"),
                 F.count_if(~rec).alias("n_abstain"),
                 *[F.count_if(F.col(label) == F.lit(c)).alias(f"n_{c}") for c in classes],
                 F.avg(F.when(rec, F.col(cee))).alias("cee_recovered_mean"),
                 F.max(F.when(rec, F.col(cee))).alias("cee_recovered_max"),
                 F.avg(F.when(~rec, F.col(cee))).alias("cee_abstained_mean"),
                 F.min(F.when(~rec, F.col(cee))).alias("cee_abstained_min"))
    med = exact_quantiles(df.where(rec), cee, [0.5]).withColumnRenamed("q_0", "cee_recovered_median")
    medv = med.first()
    out = one.withColumn("cee_recovered_median", F.lit(medv["cee_recovered_median"] if medv else None).cast("double"))
    return out.withColumn("recovery_rate_pct", F.col("n_recovered") / F.col("n_total") * 100)


def recovery_by_limit(df: DataFrame, cee: str, limits: Sequence[float]) -> DataFrame:
    """Recovery rate for each cost limit, one pass (one ``count_if`` per limit)."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(cee) <= F.lit(float(x))).alias(f"l{i}")
                                                   for i, x in enumerate(limits)])
    st = F.explode(F.array(*[F.struct(F.lit(float(x)).alias("limit"), F.col(f"l{i}").alias("n_recovered"))
                             for i, x in enumerate(limits)])).alias("s")
    return one.select("_n", st).select("s.*", (F.col("s.n_recovered") / F.col("_n") * 100).alias("recovery_rate_pct"))


def break_even(totals: DataFrame, model: str, base: str, coef: str, grid: Sequence[float]) -> DataFrame:
    """Cost line ``base + coef * x`` per model over a grid of unit costs
    (grid exploded from a literal array), the difference to the next model
    and sign changes (crossings) along the grid."""
    g = totals.withColumn("x", F.explode(F.array(*[F.lit(float(v)) for v in grid])))
    g = g.withColumn("total", F.col(base) + F.col(coef) * F.col("x"))
    w = Window.partitionBy("x").orderBy(model)  # models x grid: a small aggregate
    g = g.withColumn("diff_to_next", F.lead("total").over(w) - F.col("total"))
    w2 = Window.partitionBy(model).orderBy("x")
    return g.withColumn("crossing", (F.signum("diff_to_next") != F.lag(F.signum("diff_to_next")).over(w2)))


def cost_uncertainty(cells: DataFrame, records: DataFrame, cell_cols: Sequence[str], value: str,
                     model_cols: Sequence[str] = ()) -> DataFrame:
    """Per (model, cell) variance contribution ``coef^2 * var_samp(cost)``,
    its share of the total and the +/- 1 sigma effect ``coef * sd``."""
    v = records.groupBy(*cell_cols).agg(F.var_samp(F.col(value)).alias("var_cost"), F.count(F.lit(1)).alias("n_obs"))
    j = cells.join(v, list(cell_cols))
    j = j.withColumn("var_contrib", F.col("coef") * F.col("coef") * F.col("var_cost")) \
        .withColumn("sigma_effect", F.col("coef") * F.sqrt("var_cost"))
    tot = j.groupBy(*model_cols).agg(F.sum("var_contrib").alias("_tot"))
    j = j.join(tot, list(model_cols)) if model_cols else j.withColumn(
        "_tot", F.lit(j.agg(F.sum("var_contrib")).first()[0]))
    return j.withColumn("var_share", F.col("var_contrib") / F.col("_tot")).drop("_tot")


def _poisson1(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF of a uniform."""
    cdf, k, p = [], 0, math.exp(-1.0)
    acc = 0.0
    while acc < 1 - 1e-12 and k < 12:
        acc += p
        cdf.append(acc)
        k += 1
        p = p / k
    expr = None
    for i, c in enumerate(cdf):
        expr = F.when(u < F.lit(c), F.lit(i)) if expr is None else expr.when(u < F.lit(c), F.lit(i))
    return expr.otherwise(F.lit(len(cdf)))


def bootstrap_mean(df: DataFrame, value: str, key: str, replicates: int = 200, blocks: int = 1024,
                   alpha: float = 0.05, seed: int = 13) -> DataFrame:
    """Poisson bootstrap interval of a mean. Rows collapse to ``blocks``
    block sums first (hash of the key), so the replicate expansion is
    ``blocks x replicates`` regardless of the row count; Poisson(1) weights come
    from a hash of (block, replicate, seed): deterministic under task retries."""
    b = (df.where(F.col(value).isNotNull())
         .groupBy(F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).alias("block"))
         .agg(F.sum(F.col(value).cast("double")).alias("s"), F.count(F.lit(1)).alias("c")))
    r = b.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    u = (F.pmod(F.xxhash64("block", "rep", F.lit(seed)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30)))
    r = r.withColumn("w", _poisson1(u))
    reps = r.groupBy("rep").agg((F.sum(F.col("w") * F.col("s")) / F.sum(F.col("w") * F.col("c"))).alias("mean"))
    q = exact_quantiles(reps, "mean", [alpha / 2, 1 - alpha / 2])
    point = df.agg(F.avg(value).alias("estimate"))
    est = point.first()["estimate"]
    return q.select(F.lit(est).alias("estimate"), F.col("q_0").alias("lower"), F.col("q_1").alias("upper"),
                    F.lit(replicates).alias("replicates"))
