"""Lexical retrieval packing.

Documents are tokenised once and laid out in shards: contiguous ranges of a
lexical order (their most frequent tokens), each of bounded size. A shard holds
a BM25 inverted index of its documents, with document frequencies and lengths
of the whole corpus. A seed document's rarest terms retrieve its best unused
neighbours, which fill the seed's window greedily; the last one is cut at the
window's end and its rest seeds the next window, so only a shard's last window
is padded. Full windows of long documents are sequences of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land
from .tokens import default_path, encoder

WINDOW = 1024
TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Tokens of a shard, at which it is packed.
SHARD_TOKENS = 2_000_000
#: Terms of a retrieval query, and results asked for at once.
QUERY_TERMS, RESULTS = 16, 48
K1, B = 1.2, 0.75

TOKENS = "id {id}, n long, top int, second int, ids binary, term int, df long, kind int"
PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _tokenise(path: str, end: int, id_type: pa.DataType):
    """Kind 0: a document's ids; kind 1: documents of the task that hold a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, df = encoder(path), None
        for b in batches:
            ids = [np.frombuffer(x, enc.dtype) for x in enc.encode([t or "" for t in b.column("text").to_pylist()])]
            top = np.zeros((len(ids), 2), np.int32)
            if df is None:
                df = np.zeros(enc.tokenizer.get_vocab_size(), np.int64)
            for i, x in enumerate(ids):
                if len(x):
                    terms, count = np.unique(x, return_counts=True)
                    df[terms] += 1
                    order = np.argsort(-count, kind="stable")[:2]
                    top[i, :len(order)] = terms[order]
            blobs = [np.append(x, np.array([end], enc.dtype)).astype("<u4").tobytes() if enc.wide
                     else np.append(x, np.array([end], enc.dtype)).tobytes() for x in ids]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array(top[:, 0]), pa.array(top[:, 1]),
                 pa.array(blobs, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                 pa.array(np.zeros(n, np.int32))], names=["id", "n", "top", "second", "ids", "term", "df", "kind"])
        if df is not None:
            at = np.flatnonzero(df)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.binary()), pa.array(at.astype(np.int32)), pa.array(df[at]), pa.array(np.ones(n, np.int32))],
                names=["id", "n", "top", "second", "ids", "term", "df", "kind"])
    return run


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, average: float):
        terms, owners, weights, self.query = [], [], [], []
        for i, x in enumerate(docs):
            t, tf = np.unique(x[:-1], return_counts=True)
            w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(x) / average))
            terms.append(t.astype(np.int64))
            owners.append(np.full(len(t), i, np.int32))
            weights.append(w.astype(np.float32))
            self.query.append(t[np.argsort(-w, kind="stable")[:QUERY_TERMS]].astype(np.int64))
        terms = np.concatenate(terms)
        order = np.argsort(terms, kind="stable")
        self.owners, self.weights = np.concatenate(owners)[order], np.concatenate(weights)[order]
        self.start = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.size = len(docs)

    def neighbours(self, seed: int, unused: np.ndarray) -> list[int]:
        """Best unused documents for a seed, at most RESULTS, best first."""
        spans = [slice(self.start[t], self.start[t + 1]) for t in self.query[seed]]
        if not spans:
            return []
        score = np.bincount(np.concatenate([self.owners[s] for s in spans]),
                            np.concatenate([self.weights[s] for s in spans]), self.size)
        score[~unused] = 0
        best = np.flatnonzero(score)
        if len(best) > RESULTS:
            best = best[np.argpartition(-score[best], RESULTS)[:RESULTS]]
        return best[np.lexsort((best, -score[best]))].tolist()


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, average: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    pieces, seq = [], 0
    tail = np.array([len(x) % window for x in docs])
    for i, x in enumerate(docs):
        for start in range(0, len(x) - window + 1, window):
            pieces.append((i, start, window, seq, 0))
            seq += 1
    unused = tail > 0
    index = Index(docs, idf, average)
    order = iter(np.flatnonzero(unused).tolist())
    ranked: list[int] = []
    room, last = window, None

    def following() -> int | None:
        """Best unused neighbour of the window's seed, then of the last document, then the next in order."""
        nonlocal ranked
        for again in (False, True):
            while ranked:
                i = ranked.pop()
                if unused[i]:
                    return i
            if not again and last is not None:
                ranked = index.neighbours(last, unused)[::-1]
        return next((i for i in order if unused[i]), None)

    while (i := following()) is not None:
        unused[i] = False
        start, left = len(docs[i]) - int(tail[i]), int(tail[i])
        if room == window:
            ranked = index.neighbours(i, unused)[::-1]
        while left:
            take = min(left, room)
            pieces.append((i, start, take, seq, window - room))
            start, left, room = start + take, left - take, room - take
            if not room:
                seq, room = seq + 1, window
                ranked = index.neighbours(i, unused)[::-1] if left else []
        last = i if room < window else None
    return pieces


def _pack(idf: np.ndarray, average: float, window: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, id_type = TaskContext.get().partitionId() << 36, None

        def flush(ids: list, docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal base
            pieces = pack_shard(docs, idf, average, window)
            last = pieces[-1][3] if pieces else 0
            for at in range(0, len(pieces), 2000):
                p = pieces[at:at + 2000]
                last = max(last, max(x[3] for x in p))
                cols = [pa.array([ids[i] for i, *_ in p], id_type), *(pa.array([x[k] for x in p], pa.int64()) for k in (1, 2)),
                        pa.array([docs[i][s:s + m].astype("<u4").tobytes() for i, s, m, *_ in p], pa.binary()),
                        pa.array([len(docs[i]) for i, *_ in p], pa.int64()),
                        pa.array([base + x[3] for x in p], pa.int64()), pa.array([x[4] for x in p], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids", "doc_tokens",
                                                              "sequence_id", "offset"])
            base += last + 1

        ids, docs, size = [], [], 0
        for b in batches:
            id_type = b.schema.field("id").type
            for i, x in zip(b.column("id").to_pylist(), b.column("ids"), strict=True):
                ids.append(i)
                docs.append(np.frombuffer(x.as_py(), dtype))
                size += len(docs[-1])
                if size >= SHARD_TOKENS:
                    yield from flush(ids, docs)
                    ids, docs, size = [], [], 0
        if docs:
            yield from flush(ids, docs)
    return run


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, end: int = END, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document of its ids and ``end``; a null text is
    the end id alone. Each id lies in exactly one piece, a sequence's pieces
    are gapless from 0 and end at ``window`` or, once a shard, before it.
    Repeated rows are documents of their own; null ids stay null; an empty
    table gives no rows. Columns other than the two named are not read."""
    path = path or default_path(TOKENIZER)
    enc = encoder(path)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    found = land(rows.mapInArrow(_tokenise(path, end, to_arrow_type(rows.schema["id"].dataType)), TOKENS.format(id=kind)),
                 "tokens")
    docs_ = found.where("kind = 0")
    total = docs_.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")).first()
    n_docs, tokens = total["docs"], total["tokens"] or 0
    # one row a vocabulary entry
    df = np.zeros(enc.tokenizer.get_vocab_size())
    for r in found.where("kind = 1").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    order = ["top", "second", "id", "n"]
    shards = (docs_.select("id", "n", "top", "second", "ids")
              .repartitionByRange(max(1, -(-tokens // SHARD_TOKENS)), *order).sortWithinPartitions(*order))
    return shards.select("id", "ids").mapInArrow(
        _pack(idf, tokens / max(1, n_docs), window, enc.dtype), PIECES.format(id=kind))
