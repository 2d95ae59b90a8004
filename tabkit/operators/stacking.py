"""Stacked models (A12 regression, A13 fusion): out-of-fold predictions train the
meta-model, base models refitted on all rows feed it afterwards.

Folds come from the key's md5 (rule M23), so a retried task or a rerun deals
every row alike. The out-of-fold frame holds the key, the label and the base
predictions only and is landed once; models never see a row's own label through
its out-of-fold prediction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import scalars
from .order import land
from .split import key_hash


@dataclass
class Base:
    """A named base model: its inputs are assembled to ``features``; ``output`` is
    ``prediction`` or ``probability``."""
    name: str
    estimator: Estimator
    inputs: Sequence[str]
    output: str = "prediction"

    def assemble(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(self.inputs), outputCol="features", handleInvalid="error").transform(df)

    def predicted(self, model, df: DataFrame) -> DataFrame:
        """``df`` with the model's output as an array column named after it."""
        out = model.transform(self.assemble(df))
        value = vector_to_array(self.output) if self.output == "probability" else F.array(F.col(self.output).cast("double"))
        return out.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(self.name))


def ridge_meta(train: DataFrame, label: str, alpha: float) -> LinearRegression:
    """Ridge with the penalty alpha * |w|^2 on the sum of squares, unscaled."""
    st = scalars(train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("s")))
    # the solver divides the penalty by the rows and by the label's deviation
    reg = float(alpha) / st["n"] * (st["s"] or 1.0) if st["n"] else 0.0
    return LinearRegression(featuresCol="meta", labelCol=label, regParam=reg, elasticNetParam=0.0, standardization=False,
                            solver="normal")


def balanced_logistic_meta(train: DataFrame, label: str, c: float = 1.0, max_iter: int = 500) -> LogisticRegression:
    """Logistic regression with class weights n / (k n_c), penalty 1 / c on the sum of losses."""
    n = train.count()
    return LogisticRegression(featuresCol="meta", labelCol=label, weightCol="meta_weight", regParam=1.0 / (c * max(1, n)),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter)


def joined_outputs(names: Sequence[str]) -> Column:
    return array_to_vector(F.concat(*[F.col(f"`{n}`") for n in names]))


@dataclass
class Stacked:
    """Fitted base models and meta-model."""
    bases: list[tuple[Base, object]]
    meta: object
    out_of_fold: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with each base's output (array), and the meta-model's ``prediction``
        (and ``probability`` where it has one, as an array)."""
        for base, model in self.bases:
            df = base.predicted(model, df)
        out = self.meta.transform(df.withColumn("meta", joined_outputs([b.name for b, _ in self.bases])))
        extra = [F.col("prediction")] + ([vector_to_array("probability").alias("probability")] if "probability" in out.columns else [])
        return out.select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def dealt_rows(train: DataFrame, key: Sequence[str], label: str, bases: Sequence[Base], folds: int) -> DataFrame:
    """key, label, the bases' inputs and the row's ``fold``, landed: every fit reads them again."""
    names = dict.fromkeys([*key, label, *[c for b in bases for c in b.inputs]])
    fold = F.pmod(key_hash(F.concat_ws("|", *key)), F.lit(folds)).cast("int")
    return land(train.select(*[F.col(f"`{c}`") for c in names], fold.alias("fold")), "dealt")


def out_of_fold(train: DataFrame, key: Sequence[str], label: str, bases: Sequence[Base], folds: int = 3) -> DataFrame:
    """key, label and each base's output for every row, from the models that were
    fitted without the row's fold. Rows whose folds leave a fit empty raise."""
    dealt = train if "fold" in train.columns else dealt_rows(train, key, label, bases, folds)
    parts = None
    for k in range(folds):
        held = dealt.where(F.col("fold") == k)
        if held.isEmpty():
            continue
        for base in bases:
            held = base.predicted(base.estimator.fit(base.assemble(dealt.where(F.col("fold") != k))), held)
        part = held.select(*key, label, *[b.name for b in bases])
        parts = part if parts is None else parts.unionByName(part)
    return land(parts, "out_of_fold")


def fit_stacking(train: DataFrame, key: Sequence[str], label: str, bases: Sequence[Base], folds: int = 3,
                 alpha: float = 1.0, classify: bool = False) -> Stacked:
    """Fit on ``train``; the meta-model is ridge (``alpha``), or a balanced logistic
    regression over the joined class probabilities with ``classify``. No raw
    feature reaches it. Rows with a null label are left out."""
    if clash := {*(b.name for b in bases), "features", "fold", "meta", "meta_weight"} & set(train.columns):
        raise ValueError(f"columns with reserved names: {sorted(clash)}")
    train = dealt_rows(train.where(F.col(label).isNotNull()), key, label, bases, folds)
    held = out_of_fold(train, key, label, bases, folds)
    frame = held.withColumn("meta", joined_outputs([b.name for b in bases]))
    if classify:
        from .models import balanced_weights
        frame = balanced_weights(frame, label, out="meta_weight")
        meta = balanced_logistic_meta(held, label).fit(frame)
    else:
        meta = ridge_meta(held, label, alpha).fit(frame)
    return Stacked([(b, b.estimator.fit(b.assemble(train))) for b in bases], meta, held)
