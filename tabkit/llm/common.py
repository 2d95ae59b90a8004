"""Helpers shared by the operators: tables, shared scratch tables, row locators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import types
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The six ASCII white-space characters of ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in
    files that outlive any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Name of the locator column; a column of that name gets another one meanwhile (``keeps_locator_name``).
LOC = "__loc"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_2, name_3, ... that is no column of ``df``."""
    taken, k = {c.lower() for c in df.columns}, 1
    while (out := name if k == 1 else f"{name}_{k}").lower() in taken:
        k += 1
    return out


def keeps_locator_name(drop):
    """For functions that take and return the columns of their first argument."""
    @functools.wraps(drop)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        if LOC not in docs.columns:
            return drop(docs, *args, **kwargs)
        other = free_name(docs, LOC)
        return drop(docs.withColumnRenamed(LOC, other), *args, **kwargs).withColumnRenamed(other, LOC)
    return run


def located(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__loc`` = (file, row): where Spark can read the row again.

    Rows of a file scan keep their own file and row number; any other frame is
    first written to the shared folder."""
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.withColumn(LOC, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row")))
    except AnalysisException:
        return located(land(docs, "docs"))


def pick(*names: str) -> list[Column]:
    """The named columns; extra columns never enter a plan."""
    return [F.col(f"`{n}`") for n in names]


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one aggregate): sizes buckets and shards."""
    return int(docs.select(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0)


def releasing(fn):
    """For functions of Python workers: hands freed memory back to the system when
    a call, or what it yields, ends. Workers are kept between tasks and would hold
    their largest task's memory beside the JVM's joins."""
    def release():
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # glibc only
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    @functools.wraps(fn)
    def run(data):
        out = fn(data)
        if not isinstance(out, types.GeneratorType):
            release()
            return out

        def rows():
            yield from out
            release()
        return rows()
    return run


#: Classes of a broadcast pre-filter: at most this many longs travel.
CLASSES = 1 << 20


def in_classes(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows whose key's hash class occurs among the wanted keys: every wanted
    row and, where keys are many, some others. Broadcasts at most ``CLASSES``
    longs whatever the input; cuts what a later join has to move."""
    cls = wanted.select(F.pmod(F.xxhash64(wanted_key), F.lit(CLASSES)).alias("__cls")).distinct()
    return (df.withColumn("__cls", F.pmod(F.xxhash64(key), F.lit(CLASSES)))
            .join(F.broadcast(cls), "__cls", "left_semi").drop("__cls"))
