"""Best-fit packing with exact complements.

Documents are tokenised once; one longer than the window is cut into whole
windows behind a shorter first piece. How many pieces there are of each length
(at most ``window`` numbers, whatever the corpus) decides a plan: lengths from
the longest down look up the combination of one, two or three available lengths
whose sum is exactly the gap they leave, and the combination is consumed as
often as the counts allow; what has no complement is packed by best fit, and
every gap that arises there is looked up again. A plan is a list of patterns
with a multiplicity. A piece finds its place by its rank among the pieces of its
length, which comes from per-task counts and offsets, so no length, however
common, is gathered in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land
from .tokens import default_path, encoder

WINDOW = 2048
TOKENIZER = "byte_bpe_50k.json"
END = 0

PIECES = "doc_id {id}, piece int, start long, length long, ids binary, doc_tokens long, part int, nth long"
PLACED = "doc_id {id}, piece int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Sums:
    """Available lengths by the sums of one, two and three of them.

    ``pairs[s]`` counts the pairs of available lengths with sum s, so a sum has
    a pair or, with one more length, a triple without looking at the lengths."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()
        self.window = len(counts) - 1
        one = (self.counts > 0).astype(np.int64)
        pairs = np.convolve(one, one)[:self.window + 1]
        twins = np.arange(0, self.window + 1, 2)
        pairs[twins] -= one[twins // 2]  # now every ordered pair of different lengths
        self.pairs = pairs // 2
        self.pairs[twins] += self.counts[twins // 2] > 1

    def take(self, length: int, n: int) -> None:
        old, new = int(self.counts[length]), int(self.counts[length]) - n
        self.counts[length] = new
        if old > 1 >= new and 2 * length <= self.window:
            self.pairs[2 * length] -= 1
        if old and not new:
            other = np.flatnonzero(self.counts[:self.window - length + 1] > 0)
            self.pairs[length + other] -= 1

    def free(self, used: Counter) -> np.ndarray:
        left = self.counts.copy()
        for length, n in used.items():
            left[length] -= n
        return left

    def pair(self, total: int, left: np.ndarray) -> list[int] | None:
        """Two lengths of that sum, the larger one as large as can be."""
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange(total - 1, (total - 1) // 2, -1)
        b = total - a
        ok = (left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1))
        at = int(np.argmax(ok)) if len(ok) else 0
        return [int(a[at]), int(b[at])] if len(ok) and ok[at] else None

    def filling(self, gap: int, used: Counter) -> list[int] | None:
        """One, two or three lengths that fill the gap exactly, beside those used."""
        left = self.free(used)
        if left[gap] > 0:
            return [gap]
        if found := self.pair(gap, left):
            return found
        for c in range(gap - 2, 0, -1):
            if 3 * c < gap:
                return None  # the largest of three is at least a third
            if left[c] > 0 and self.pairs[gap - c]:
                left[c] -= 1
                if found := self.pair(gap - c, left):
                    return [c, *found]
                left[c] += 1
        return None


def plan(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """(multiplicity, {length: uses}) of every pattern; ``counts[i]`` pieces have
    length i, and the window is ``len(counts) - 1``."""
    window, sums, out = len(counts) - 1, Sums(counts), []

    def consume(used: Counter) -> None:
        times = min(int(sums.counts[x]) // n for x, n in used.items())
        for x, n in used.items():
            sums.take(x, n * times)
        out.append((times, dict(sorted(used.items(), reverse=True))))

    for head in range(window, 0, -1):
        while sums.counts[head] > 0:
            used = Counter([head])
            if head < window:
                if not (rest := sums.filling(window - head, used)):
                    break
                used.update(rest)
            consume(used)
    while sums.counts.any():
        head = int(np.flatnonzero(sums.counts)[-1])
        used, gap = Counter([head]), window - head
        while gap:
            if rest := sums.filling(gap, used):
                used.update(rest)
                break
            left = sums.free(used)
            fits = np.flatnonzero(left[:gap + 1] > 0)
            if not len(fits):
                break
            best = int(fits[-1])
            n = min(gap // best, int(left[best]))
            used[best] += n
            gap -= n * best
        consume(used)
    return out


class Places:
    """Where the r-th piece of a length goes."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]], window: int):
        next_rank, rows, sequence = np.zeros(window + 1, np.int64), [], 0
        for times, used in patterns:
            offset = 0
            for length, n in used.items():
                rows.append((length, next_rank[length], n, sequence, offset))
                next_rank[length] += n * times
                offset += n * length
            sequence += times
        rows.sort()
        self.length, self.first, self.uses, self.sequence, self.offset = (
            np.array([r[k] for r in rows], np.int64) for k in range(5))
        self.key = self.length << 48 | self.first

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 48 | rank, side="right") - 1
        nth = rank - self.first[at]
        return self.sequence[at] + nth // self.uses[at], self.offset[at] + nth % self.uses[at] * length


def _cut(path: str, end: int, window: int):
    """Pieces with their ids (in the tokenizer's width) and the rank among the task's pieces of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc, seen = TaskContext.get().partitionId(), encoder(path), np.zeros(window + 1, np.int64)
        last, width = np.array([end], enc.dtype).tobytes(), np.dtype(enc.dtype).itemsize
        for b in batches:
            rows = []
            for i, blob in enumerate(enc.encode([t or "" for t in b.column("text").to_pylist()])):
                ids = blob + last
                n, at, piece = len(ids) // width, 0, 0
                while at < n:
                    size = (n % window or window) if not piece else window
                    rows.append((i, piece, at, size, ids[width * at:width * (at + size)], n, part, int(seen[size])))
                    seen[size] += 1
                    at, piece = at + size, piece + 1
            if rows:
                cols = list(zip(*rows, strict=True))
                types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(cols[0], pa.int64())),
                     *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))],
                    names=["doc_id", "piece", "start", "length", "ids", "doc_tokens", "part", "nth"])
    return run


def _place(places: Places, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sequence, offset = places.of(b.column("length").to_numpy(), b.column("rank").to_numpy())
                ids = [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in b.column("ids").to_pylist()]
                first, last = ["doc_id", "piece", "start", "length"], ["doc_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in first), pa.array(ids, pa.binary()), *(b.column(c) for c in last),
                     pa.array(sequence), pa.array(offset)], names=[*first, "ids", *last, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, end: int = END, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian
    uint32), doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document of its ids and ``end``; a null or empty
    text is the end id alone. Only documents longer than ``window`` are cut: the
    first piece is what their length leaves over whole windows. A sequence's
    pieces are gapless from 0 and at most ``window`` long. Repeated rows are
    documents of their own, which of them takes which place is not defined; null
    ids stay null; an empty table gives no rows. Columns other than the two
    named are not read."""
    path = path or default_path(TOKENIZER)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = land(rows.mapInArrow(_cut(path, end, window), PIECES.format(id=kind)), "pieces")
    totals = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(window + 1, np.int64)
    for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length, at most window
        counts[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", "doc_tokens", (F.col("nth") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(_place(Places(plan(counts), window), encoder(path).dtype), PLACED.format(id=kind))


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of ``pack``: sequence_id, n_tokens, doc_ids and
    lengths of its pieces in order, and ids (little-endian uint32, unpadded).
    A group holds at most ``window`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"),
                    F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
