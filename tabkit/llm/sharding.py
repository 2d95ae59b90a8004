"""Contiguous byte-balanced shards from global prefix sums.

Rows are range-partitioned by id, each block's rows are summed on their own,
the block totals (one row a block) are turned into offsets, and a row's global
position and byte offset follow from its block. Shards are cut at equal byte
targets. Only (id, size, crc) travels; texts are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land

ROW_OVERHEAD = 8


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32 in global id order with ``block`` and ``idx``: a
    block is one range partition, idx ascends inside it. Written to the shared
    folder, so that a lost executor cannot renumber rows."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # the last key only deals rows of one id (or without id) over several ranges
    rows = (rows.withColumn("tie", F.monotonically_increasing_id())
            .repartitionByRange(F.col("id").asc_nulls_last(), F.col("text_crc32"), F.col("tie"))
            .sortWithinPartitions(F.col("id").asc_nulls_last(), "text_crc32", "tie"))
    return land(rows.select("id", "size", "text_crc32", F.spark_partition_id().alias("block"),
                            F.monotonically_increasing_id().alias("idx")), "sized")


def with_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``before`` (bytes of all rows before) and ``pos`` (rows before)."""
    totals = rows.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    prior = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("block", F.coalesce(F.sum("bytes").over(prior), F.lit(0)).alias("base"),
                          F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("base_n"))
    inside = Window.partitionBy("block").orderBy("idx")
    return (rows.withColumn("run", F.sum("size").over(inside) - F.col("size"))
            .withColumn("nr", F.row_number().over(inside) - 1)
            .join(bases, "block")
            .select("id", "size", "text_crc32", (F.col("base") + F.col("run")).alias("before"),
                    (F.col("base_n") + F.col("nr")).cast("long").alias("pos")))


def byte_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot, before.

    Size is the UTF-8 length of the text (null: 0) plus 8. A row goes to the
    shard in which its middle byte falls when all bytes, in id order (null ids
    last, equal ids by crc), are cut into ``shards`` equal stretches; so shards
    are contiguous and differ from the target by less than one row. ``slot``
    counts from 0 inside a shard. Repeated rows are rows of their own; an empty
    table gives no rows."""
    placed = with_offsets(sized_rows(docs, id_col, text_col))
    total = placed.agg(F.max(F.col("before") + F.col("size")).alias("total"))
    mid = (2 * F.col("before") + F.col("size")).cast("decimal(38,0)")
    cut = F.floor(mid * F.lit(shards) / (2 * F.col("total").cast("decimal(20,0)"))).cast("int")
    placed = placed.join(F.broadcast(total)).withColumn("shard", F.least(F.lit(shards - 1), cut))
    # one row a shard
    first = placed.groupBy("shard").agg(F.min("pos").alias("first"))
    return (placed.join(F.broadcast(first), "shard")
            .select("id", "size", "text_crc32", "shard", (F.col("pos") - F.col("first")).alias("slot"), "before"))
