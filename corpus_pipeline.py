"""Corpus pipeline: toxicity, exact dedup, near dedup, decontamination, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabkit.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from tabkit.llm.common import land, table
from tabkit.session import ensure_checkpoint_dir, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, does not reject."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    ensure_checkpoint_dir(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest id."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return jaccard_join.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ensure_checkpoint_dir(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids: one row a piece, with its ids."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("packing", pack)]

#: Learned lexicon, tokenizer and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
