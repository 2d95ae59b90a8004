"""Registry of named query plans over the generated tables.

Each plan is ``fn(spark, sf_dir) -> DataFrame`` plus, where SQL can express
it, an equivalent DuckDB SQL string over the same tables. Output columns are
aliased identically on both sides, and computed doubles are rounded to a
fixed number of digits on both sides so that summation order cannot change
the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import table

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
OPS: dict[str, str] = {}


def plan(name: str, op: str, sql: str | None = None):
    """Register ``fn`` under ``name`` for operator id(s) ``op``."""

    def deco(fn):
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = fn
        OPS[name] = op
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return deco


class Tables:
    """Lazy access to the generated tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def rnd(c: str | Column, digits: int = 6) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double"), digits)


def round_all(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every floating column (for oracle comparison)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in skip:
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
