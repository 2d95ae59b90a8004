"""Repeated passages by Rabin-Karp hashes of every fixed-length word window.

Pass 1 hashes every window of every document (a rolling polynomial over word
hashes) and counts the hashes in Spark by bucket: a window whose hash was seen
first in a smaller id is a repeat. Pass 2 brings each document's repeated
hashes to its text, and overlapping repeated windows merge into maximal
removal intervals.

The count travels as blobs (see ``ring``); within a slice only the first
document of a hash is sent, later ones are known repeats already, so a passage
that a third of all documents share costs one entry a slice. Later rows of the same
id as the first are its ties: what is found for the first holds for them, and a
pass over the finds, run only where ids repeat, tells them.

Texts and their repeats meet by a hash of the row's locator, never by the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOC, located, text_bytes
from .ring import (SLICE_ENTRIES, U64, bucket_slices, buckets_for, cut_runs, mix, pack_hashes, pack_owners,
                   unpack_hashes, unpack_owners, word_hashes)

WINDOW = 50
#: Odd base of the rolling hash modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Stands for a null id: after every other id.
NO_ID = (1 << 63) - 1

#: home -1: entries of a bucket, owners are (id, row). Others: known repeats of
#: rows (home of the row), or ties (home of the first), owners are (first, row).
WIRE = "bucket long, home long, tie boolean, first long, hashes binary, numbers binary, owners binary"
COLUMNS = ("bucket", "home", "tie", "first", "hashes", "numbers", "owners")


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, U64)
    p[:1] = 1
    return np.cumprod(p, dtype=U64)


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """Rolling hash of every window, by prefix sums modulo 2^64."""
    n = len(words)
    if n < window:
        return np.zeros(0, U64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(word_hashes(words) * _powers(INVERSE, n), dtype=U64, out=sums[1:])
    return mix((sums[window:] - sums[:-window]) * _powers(BASE, n - window + 1))


def _wire(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "home": pa.int64(), "tie": pa.bool_(), "first": pa.int64(), "hashes": pa.binary(),
             "numbers": pa.binary(), "owners": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in kinds.items()], names=list(kinds))


def _unpack_pairs(numbers: bytes, owners: bytes) -> np.ndarray:
    pairs = np.frombuffer(owners, "<i8").reshape(-1, 2)
    return pairs[np.frombuffer(numbers, "<u2" if len(pairs) <= 1 << 16 else "<u4")]


def _known(rows: dict[str, list], h: np.ndarray, owner: np.ndarray, homes: int, buckets: int = 1) -> None:
    """Append known repeats (hash, row), one blob for each home of rows, or ties
    (hash, (first, row)), one for each home of firsts."""
    tie = owner.ndim == 2
    home = (owner[:, 0] if tie else owner) % homes
    order = np.lexsort((h, home))
    h, owner, home = h[order], owner[order], home[order]
    starts = cut_runs(home)
    for s, e in zip(starts.tolist(), np.append(starts[1:], len(h)).tolist(), strict=True):
        at = int(home[s])
        used, number = np.unique(owner[s:e], axis=0 if tie else None, return_inverse=True)
        first, blob = pack_hashes(h[s:e])
        numbers, owners = pack_owners(number.reshape(-1), used)
        for k, v in zip(COLUMNS, (at % buckets, at, tie, first, blob, numbers, owners), strict=True):
            rows[k].append(v)


def _count_windows(window: int, buckets: int, homes: int):
    def flush(keys: list[tuple[int, int]], hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        by_id = sorted(range(len(keys)), key=keys.__getitem__)
        owners = np.array([keys[i] for i in by_id], np.int64)  # (id, row)
        h = np.concatenate([hashes[i] for i in by_id])
        number = np.repeat(np.arange(len(by_id)), [len(hashes[i]) for i in by_id])
        order = np.argsort(h, kind="stable")
        h, number = h[order], number[order]
        starts = cut_runs(h)
        least = np.repeat(number[starts], np.diff(np.append(starts, len(h))))
        rows: dict[str, list] = {c: [] for c in COLUMNS}
        again = owners[number, 0] > owners[least, 0]
        if again.any():
            _known(rows, h[again], owners[number[again], 1], homes, buckets)
        tie = ~again & (number != least)
        if tie.any():
            _known(rows, h[tie], np.stack([owners[least[tie], 1], owners[number[tie], 1]], 1), homes, buckets)
        h, number = h[starts], number[starts]
        for b, s, e in bucket_slices(h, buckets):
            first, blob = pack_hashes(h[s:e])
            numbers, used = pack_owners(number[s:e], owners)
            for k, v in zip(COLUMNS, (b, -1, False, first, blob, numbers, used), strict=True):
                rows[k].append(v)
        yield _wire(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, size = [], [], 0
        for batch in batches:
            keys = zip(batch.column("id").to_pylist(), batch.column("row").to_pylist(), strict=True)
            for i, t in zip(keys, batch.column("text"), strict=True):
                h = window_hashes((t.as_py() or b"").split(), window)
                if len(h):
                    ids.append(i)
                    hashes.append(h)
                    size += len(h)
                if size >= SLICE_ENTRIES:
                    yield from flush(ids, hashes)
                    ids, hashes, size = [], [], 0
        if size:
            yield from flush(ids, hashes)
    return run


def _find_repeats(homes: int):
    def run(table: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in table.column_names}
        h, owner = [], []
        for r in table.to_pylist():
            if r["home"] >= 0:
                for c in rows:
                    rows[c].append(r[c])
            else:
                h.append(unpack_hashes(r["first"], r["hashes"]))
                owner.append(_unpack_pairs(r["numbers"], r["owners"]))
        if h:
            h, owner = np.concatenate(h), np.concatenate(owner)
            order = np.argsort(h, kind="stable")
            h, owner = h[order], owner[order]
            starts = cut_runs(h)
            least = np.repeat(np.minimum.reduceat(owner[:, 0], starts), np.diff(np.append(starts, len(h))))
            again = owner[:, 0] > least
            if again.any():
                _known(rows, h[again], owner[again, 1], homes)
        return pa.Table.from_batches([_wire(rows)])
    return run


def _by_row(known: list[dict]) -> dict[int, list[np.ndarray]]:
    out: dict[int, list[np.ndarray]] = {}
    for r in known:
        h, owner = unpack_hashes(r["first"], r["hashes"]), unpack_owners(r["numbers"], r["owners"])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
        starts = cut_runs(owner)
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(h)).tolist(), strict=True):
            out.setdefault(int(owner[s]), []).append(h[s:e])
    return out


def _tell_ties(homes: int):
    """The known repeats, and those of the ties of their rows."""
    def run(table: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in COLUMNS}
        known, ties = [], []
        for r in table.to_pylist():
            (ties if r["tie"] else known).append(r)
        for r in known:
            for c in rows:
                rows[c].append(r[c])
        by_row = _by_row(known) if ties else {}
        for r in ties:
            h, owner = unpack_hashes(r["first"], r["hashes"]), _unpack_pairs(r["numbers"], r["owners"])
            order = np.argsort(owner[:, 0], kind="stable")
            h, owner = h[order], owner[order]
            starts = cut_runs(owner[:, 0])
            for s, e in zip(starts.tolist(), np.append(starts[1:], len(h)).tolist(), strict=True):
                hit = np.isin(h[s:e], np.concatenate(by_row.get(int(owner[s, 0]), [np.zeros(0, U64)])))
                if hit.any():
                    _known(rows, h[s:e][hit], owner[s:e, 1][hit], homes)
        return pa.Table.from_batches([_wire(rows)])
    return run


def removal_intervals(words: list[bytes], repeats: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal [start, end) word intervals covered by windows in ``repeats``."""
    at = np.flatnonzero(np.isin(window_hashes(words, window), repeats))
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > window)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + window).tolist(), strict=True))


def _remove(window: int):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        by_row = _by_row([r for r in known.to_pylist() if not r["tie"]])
        ids, n_words, n_removed, kept, cuts = docs.column("id"), [], [], [], []
        for i, t in zip(docs.column("row").to_pylist(), docs.column("text"), strict=True):
            words, found = (t.as_py() or b"").split(), []
            if i in by_row:
                found = removal_intervals(words, np.concatenate(by_row[i]), window)
            n_words.append(len(words))
            n_removed.append(sum(e - s for s, e in found))
            cuts.append([{"start": s, "end": e} for s, e in found])
            for s, e in reversed(found):
                del words[s:e]
            kept.append(b" ".join(words))
        return pa.Table.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                     pa.array(cuts, spans), pa.array(kept, pa.binary())],
                                    names=["id", "n_words", "n_removed", "intervals", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, intervals (maximal
    removed word ranges), kept (the kept words joined by a space, UTF-8 bytes).

    A word goes when a window of ``window`` consecutive words that covers it
    also starts in a row with a smaller id, judged on the input. Ids are
    integers; a null id counts as the largest, and rows that share an id do not
    remove each other's words. Null texts have no words; texts shorter than a
    window keep all; an empty table gives no rows. Windows are matched by their
    64-bit hash."""
    n_bytes = text_bytes(docs, text_col)
    buckets = buckets_for(n_bytes)
    homes = buckets
    src = located(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                               F.xxhash64(F.col(LOC)["file"], F.col(LOC)["row"]).alias("row"),
                               F.col(f"`{text_col}`").cast("binary").alias("text"))
    rows = src.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    repeats = (rows.mapInArrow(_count_windows(window, buckets, homes), WIRE)
               .groupBy("bucket").applyInArrow(_find_repeats(homes), WIRE))
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        repeats = repeats.groupBy("home").applyInArrow(_tell_ties(homes), WIRE)
    return (src.withColumn("home", F.pmod("row", F.lit(homes))).groupBy("home")
            .cogroup(repeats.groupBy("home"))
            .applyInArrow(_remove(window), "id long, n_words long, n_removed long, "
                          "intervals array<struct<start:long,end:long>>, kept binary"))
