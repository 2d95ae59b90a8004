"""Counting hashed items in compact blobs.

A map task handles its rows in slices. It sorts a slice's (hash, owner)
entries, keeps one entry per hash (so a hash that fills a slice costs one
entry) and cuts the sorted run into buckets by the hash's high bits. A blob is
one bucket of one slice: 6-byte hash deltas, owner numbers and the owners.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries a bucket should hold at most, if words have at least two bytes:
#: bytes of text a bucket.
BUCKET_BYTES = 12_000_000
LEAST_BUCKETS = 64
#: Entries in a slice before it is flushed.
SLICE_ENTRIES = 2_000_000

U64 = np.uint64


def buckets_for(n_bytes: int) -> int:
    return max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits, so that high bits can pick buckets."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Monotone in the hash."""
    return ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def pack_hashes(h: np.ndarray) -> tuple[int, bytes]:
    """Ascending hashes as the first one and deltas of 6 bytes (8 if need be)."""
    d = np.diff(h)
    raw = d.astype("<u8").view(np.uint8).reshape(-1, 8)
    small = not len(d) or int(d.max()) < 1 << 48
    return int(h[:1].view(np.int64)[0]), b"\x06" + raw[:, :6].tobytes() if small else b"\x08" + raw.tobytes()


def unpack_hashes(first: int, blob: bytes) -> np.ndarray:
    width = blob[0]
    cut = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    d = np.zeros((len(cut) + 1, 8), np.uint8)
    d[1:, :width] = cut
    d = d.view("<u8").ravel().copy()
    d[0] = np.array([first], np.int64).view(U64)[0]
    return np.cumsum(d, dtype=U64)


def pack_owners(owner: np.ndarray, owners: np.ndarray) -> tuple[bytes, bytes]:
    """Owner numbers as 2 bytes where they fit, and the int64 owners used."""
    used, number = np.unique(owner, return_inverse=True)
    width = "<u2" if len(used) <= 1 << 16 else "<u4"
    return number.astype(width).tobytes(), owners[used].astype("<i8").tobytes()


def unpack_owners(numbers: bytes, owners: bytes) -> np.ndarray:
    owners = np.frombuffer(owners, "<i8")
    return owners[np.frombuffer(numbers, "<u2" if len(owners) <= 1 << 16 else "<u4")]


def cut_runs(h: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in an ascending array."""
    if not len(h):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))


def bucket_slices(h: np.ndarray, buckets: int):
    """(bucket, start, end) of an ascending hash array."""
    b = bucket_of(h, buckets)
    starts = cut_runs(b)
    ends = np.append(starts[1:], len(h))
    return zip(b[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)
