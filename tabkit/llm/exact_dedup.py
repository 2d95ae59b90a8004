"""Exact dedup by a keyed streaming state that never expires.

Every row becomes (digest, code points, id, locator); a Structured Streaming
aggregation keeps, per digest, the best row and the count in a RocksDB state
store whose files live in the shared folder. Later runs over new files with
the same ``state_dir`` go on from that state. Rows with a known digest (hits)
are then compared byte for byte: per digest the least and the greatest
normalised text must agree. A digest whose texts differ is split by text.

Everything is DataFrame code. No group is collected: state, byte check and
split are aggregates with map-side combine, and the join that hands a group's
result to its rows is an equi-join that AQE can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, LOC, in_classes, keeps_locator_name, land, located, pick, shared_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """Text without its ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def update_state(entries_path: str, spark, state_dir: str, max_files: int | None = None) -> None:
    """Feed the entry files not seen before into the keyed state (one
    ``availableNow`` run; a restart resumes from the checkpoint)."""
    own = spark.newSession()
    for k, v in {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                 "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                 # preallocated files cost 4 MB a state partition
                 "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
                 "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
                 "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}.items():
        own.conf.set(k, v)
    reader = own.readStream.schema(spark.read.parquet(entries_path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    state = (reader.parquet(entries_path).groupBy("digest")
             .agg(F.min(F.struct((-F.col("chars")).alias("neg"), F.col("id").isNull().alias("no_id"), "id", "loc"))
                  .alias("best"), F.count(F.lit(1)).alias("n")))
    query = (state.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
             .option("checkpointLocation", state_dir).start())
    query.awaitTermination()
    own.streams.resetTerminated()


def read_state(spark, state_dir: str) -> DataFrame:
    """The state as a table: digest, best (neg, no_id, id, loc), n."""
    raw = spark.read.format("statestore").load(state_dir)
    best, n = (f.name for f in raw.schema["value"].dataType.fields)
    return raw.select(F.col("key.digest").alias("digest"), F.col(f"value.`{best}`").alias("best"),
                      F.col(f"value.`{n}`").alias("n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                state_dir: str | None = None, max_files: int | None = None,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: loc, id, digest, keep_id, keep_loc,
    group_size, kept.

    Texts are equal when identical without ASCII white space (null = empty).
    The row with the most code points stays, then the smallest id (null ids
    last), then the first by locator, so exactly one row of a group stays even
    when whole rows repeat. An empty table gives no rows. Columns of ``docs``
    other than the two named are not read. ``digest`` may be any function of
    the normalised text; collisions are resolved by the byte check."""
    return _dedup(located(docs), id_col, text_col, state_dir, max_files, digest)


def _dedup(src: DataFrame, id_col: str, text_col: str, state_dir: str | None = None, max_files: int | None = None,
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    spark = src.sparkSession
    src = src.select(*pick(id_col, text_col), F.col(LOC).alias("loc"))
    raw, norm = F.col(f"`{text_col}`"), normalised(F.col(f"`{text_col}`"))
    path = shared_path(spark, "dedup-entries")
    (src.select(F.col(f"`{id_col}`").alias("id"), F.length(F.coalesce(raw, F.lit(""))).cast("long").alias("chars"),
                digest(norm).alias("digest"), "loc").write.parquet(path))
    entries = spark.read.parquet(path)
    state_dir = state_dir or shared_path(spark, "dedup-state")
    update_state(path, spark, state_dir, max_files)
    state = land(read_state(spark, state_dir), "dedup-best")

    # full bytes on hits: only rows whose digest class holds a repeated digest
    texts = in_classes(src.select(digest(norm).alias("digest"), norm.alias("norm"), "loc"), F.col("digest"),
                       state.where("n > 1"), F.col("digest"))
    clash = (texts.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
             .where("lo <> hi").select("digest"))
    clash = land(clash, "dedup-clash")
    rows = entries.join(state, "digest").select(
        "loc", "id", "digest", "chars", F.col("best.id").alias("keep_id"), F.col("best.loc").alias("keep_loc"),
        F.col("n").alias("group_size"))
    if not clash.isEmpty():
        # same digest, other bytes: the text itself is the key
        other = (texts.join(clash, "digest", "left_semi").join(entries.select("loc", "id", "chars"), "loc"))
        groups = other.groupBy("digest", "norm").agg(
            F.min(F.struct((-F.col("chars")).alias("neg"), F.col("id").isNull().alias("no_id"), "id", "loc"))
            .alias("best"), F.count(F.lit(1)).alias("group_size"))
        split = other.join(groups, ["digest", "norm"]).select(
            "loc", "id", "digest", "chars", F.col("best.id").alias("keep_id"), F.col("best.loc").alias("keep_loc"),
            "group_size")
        rows = rows.join(clash, "digest", "left_anti").unionByName(split)
    return rows.drop("chars").withColumn("kept", F.col("loc") == F.col("keep_loc"))


@keeps_locator_name
def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, columns as given."""
    src = located(docs)
    gone = _dedup(src, id_col, text_col).where("not kept").select(F.col("loc").alias(LOC))
    return src.join(gone.hint("shuffle_hash"), LOC, "left_anti").select(*pick(*docs.columns))
