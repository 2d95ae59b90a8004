"""Token ids as Arrow files of equal-length sequences and masks.

Documents are range-partitioned by id; each partition writes its ids, in id
order, as one Arrow IPC file: record batches of fixed-size-list columns
``seq`` (ids) and ``mask`` (true on real ids). Every batch but a file's last has
the same number of sequences, so the place of any sequence or document follows
from its number, and both are zero-copy slices of the memory-mapped file. A second file lists the documents
(id, start, n). Files are named anew by each attempt; only those named in the
manifest count, so a repeated task leaves no duplicates.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, shared_path
from .tokens import default_path, encoder

TOKENIZER = "word_bpe_49k.json"
END = 2
LENGTH = 1024
#: Sequences of a record batch.
BATCH = 512

MANIFEST = "part long, tokens_file string, docs_file string, n_tokens long, n_docs long"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def schema(dtype: str, length: int) -> pa.Schema:
    kind = pa.uint16() if dtype == "<u2" else pa.uint32()
    return pa.schema([("seq", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a stream of ids into sequences; the last one is padded with 0."""

    def __init__(self, sink, dtype: str, length: int):
        self.dtype, self.length = dtype, length
        self.schema = schema(dtype, length)
        self.file = ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.size = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        while self.size >= BATCH * self.length:
            self._flush(BATCH * self.length)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.held)
        out, rest = flat[:n], flat[n:]
        pad = -len(out) % self.length
        mask = np.ones(len(out) + pad, bool)
        if pad:
            mask[len(out):] = False
            out = np.append(out, np.zeros(pad, self.dtype))
        values = [pa.array(out, self.schema.field("seq").type.value_type), pa.array(mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(v, self.length) for v in values], schema=self.schema))
        self.held, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.size:
            self._flush(self.size)
        self.file.close()


def _write(folder: str, path: str, end: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc, where = encoder(path), open_fs(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        where[0].create_dir(where[1], recursive=True)
        writer = None
        with contextlib.ExitStack() as open_files:
            for b in batches:
                if not b.num_rows:
                    continue
                if writer is None:
                    sink, side = [open_files.enter_context(where[0].open_output_stream(f"{where[1]}/{name}{kind}"))
                                  for kind in (".arrow", ".docs.arrow")]
                    writer = SequenceWriter(sink, enc.dtype, length)
                    kinds = pa.schema([("id", b.schema.field("id").type), ("start", pa.int64()), ("n", pa.int64())])
                    docs, n_docs = ipc.new_file(side, kinds), 0
                starts, sizes = [], []
                for x in enc.encode([t or "" for t in b.column("text").to_pylist()]):
                    ids = np.append(np.frombuffer(x, enc.dtype), np.array([end], enc.dtype))
                    starts.append(writer.total)
                    sizes.append(len(ids))
                    writer.add(ids)
                n_docs += len(sizes)
                docs.write_batch(pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=kinds))
            if writer is not None:
                writer.close()
                docs.close()
        if writer is not None:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "tokens_file": [f"{folder}/{name}.arrow"],
                "docs_file": [f"{folder}/{name}.docs.arrow"], "n_tokens": pa.array([writer.total], pa.int64()),
                "n_docs": pa.array([n_docs], pa.int64())})
    return run


def write_files(docs: DataFrame, folder: str | None = None, path: str | None = None, end: int = END,
                length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return their manifest (part, tokens_file, docs_file,
    n_tokens, n_docs, base); ``base`` counts the ids of all files before.

    Every row is a document: the ids of its whole text, then ``end``. Order is
    by id, null ids last, equal ids by the text's hash. A null text is the end
    id alone. An empty table writes no file. Other columns are not read."""
    folder = folder or shared_path(docs.sparkSession, "token-files")
    path = path or default_path(TOKENIZER)
    keys = [F.col("id").asc_nulls_last(), F.col("tie"), F.col("at")]
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"), F.monotonically_increasing_id().alias("at"))
            .repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text"))
    manifest = land(rows.mapInArrow(_write(folder, path, end, length), MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class SequenceFile:
    """Random access to a file of sequences; the batch asked for last stays open."""

    def __init__(self, tokens_file: str):
        where, path = open_fs(tokens_file)
        self.source = pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path)
        self.file = ipc.open_file(self.source)
        self.length = self.file.schema.field("seq").type.list_size
        self.batch_rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self.held: tuple[int, pa.RecordBatch | None] = (-1, None)

    def __enter__(self) -> SequenceFile:
        return self

    def __exit__(self, *_) -> None:
        self.source.close()

    def _column(self, name: str, k: int) -> np.ndarray:
        if self.held[0] != k:
            self.held = (k, self.file.get_batch(k))
        return self.held[1].column(name).flatten().to_numpy(zero_copy_only=name == "seq")

    def flat(self, name: str, start: int, n: int) -> np.ndarray:
        """Entries ``start`` to ``start + n`` of a column, or those that exist: a
        slice where they lie in one batch, a copy where not."""
        out, size = [np.zeros(0, bool if name == "mask" else np.uint32)], self.batch_rows * self.length
        while n > 0 and start // size < self.file.num_record_batches:
            k, lo = divmod(start, size)
            got = self._column(name, k)[lo:lo + n]
            if not len(got):
                break
            out.append(got)
            start, n = start + len(got), n - len(got)
        return out[-1] if len(out) <= 2 else np.concatenate(out[1:])

    def ids(self, start: int, n: int) -> np.ndarray:
        return self.flat("seq", start, n)

    def sequences(self, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequences ``first`` to ``first + n``, or those that exist, and their masks."""
        return tuple(self.flat(c, first * self.length, n * self.length).reshape(-1, self.length) for c in ("seq", "mask"))


def read_sequences(tokens_file: str, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences ``first`` to ``first + n`` of a file and their masks; only their
    batches are read. A slice of the memory map where the file system has one."""
    return SequenceFile(tokens_file).sequences(first, n)


def _read(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in (r for b in batches for r in b.to_pylist()):
            docs_at = open_fs(m["docs_file"])
            with SequenceFile(m["tokens_file"]) as file, docs_at[0].open_input_file(docs_at[1]) as side:
                docs = ipc.open_file(side)
                for k in range(docs.num_record_batches):
                    d = docs.get_batch(k)
                    for lo in range(0, d.num_rows, 500):
                        part = d.slice(lo, 500)
                        places = zip(part.column("start").to_pylist(), part.column("n").to_pylist(), strict=True)
                        blobs = [file.ids(start, n).astype("<u4").tobytes() for start, n in places]
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").cast(id_type),
                             pa.array(np.asarray(part.column("start")) + m["base"], pa.int64()), part.column("n"),
                             pa.array(blobs, pa.binary())], names=["id", "start", "n_tokens", "ids"])
    return run


def read_documents(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per document, read from the files: id, start (ids before it in
    all files), n_tokens, ids (little-endian uint32). Every file is a task's: the
    manifest is small, its files are not, so tasks are not left to its size."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    kind = StructType.fromDDL(f"id {id_type}")[0].dataType
    files = max(1, manifest.count())
    rows = manifest.repartitionByRange(files, "part").select("tokens_file", "docs_file", "base")
    return rows.mapInArrow(_read(to_arrow_type(kind)), f"id {id_type}, start long, n_tokens long, ids binary")
