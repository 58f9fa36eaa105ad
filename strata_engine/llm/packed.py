"""Packed (key, owner) entries: counting keys over all tasks without a row
per key.

A task sorts the 64-bit keys it has gathered and sends, per bucket of keys,
one row with two byte strings. Keys that it holds several times itself are
sent once, without owner, so a key of a third of all documents is one entry
per task. A bucket then holds a bounded share of the distinct keys. What it
finds goes back as one row per segment (the entries that a task sent off
together), so rows do not multiply by buckets and owners.
"""

from __future__ import annotations

import numpy as np

#: Owner of an entry that stands for several occurrences in its task.
SEVERAL = np.iinfo(np.int64).min


def by_bucket(keys: np.ndarray, buckets: int, *columns: np.ndarray):
    """(bucket, [keys, *columns] as bytes) for every bucket that has entries."""
    if not len(keys):
        return
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    hit, start = np.unique(bucket[order], return_index=True)
    for b, rows in zip(hit.tolist(), np.split(order, start[1:])):
        yield b, [x[rows].tobytes() for x in (keys, *columns)]


def unpack(column, kind) -> np.ndarray:
    """All byte strings of an Arrow column, one after the other."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def ends_of(column, width: int) -> np.ndarray:
    """Where each byte string of the column ends among the unpacked values
    (without the last), for np.split."""
    return np.cumsum([len(x.as_buffer()) // width if x.is_valid else 0 for x in column])[:-1]


def split_hits(rows, column: str, hit: np.ndarray, *values: np.ndarray) -> list[list[bytes]]:
    """For each input row (one segment's part of a bucket) its hits only:
    one list of byte strings for each array of ``values``."""
    if not rows.num_rows:
        return [[] for _ in values]
    ends = ends_of(rows.column(column), 8)
    marks = np.split(hit, ends)
    return [[v[m].tobytes() for v, m in zip(np.split(x, ends), marks)] for x in values]


def spread(owners: np.ndarray, values: np.ndarray):
    """(owners, the values of each as bytes)."""
    order = np.argsort(owners, kind="stable")
    ids, start = np.unique(owners[order], return_index=True)
    return ids, [v.tobytes() for v in np.split(values[order], start[1:])] if len(ids) else []


def shared_here(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their owner or SEVERAL, for every entry whether its
    key occurs more than once)."""
    distinct, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    owner = np.where(counts == 1, owners[first], SEVERAL) if len(keys) else np.zeros(0, np.int64)
    return distinct, owner, counts[inverse] >= 2


def shared_of_all(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For the entries of all tasks: which have an owner that shares its key
    with another owner."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.lexsort((owners, keys))
    k, o = keys[order], owners[order]
    start = np.append(0, np.flatnonzero(k[1:] != k[:-1]) + 1)
    end = np.append(start[1:], len(k))
    # owners are sorted within a key; SEVERAL is the least
    several = (o[start] != o[end - 1]) | (o[start] == SEVERAL)
    out = np.zeros(len(k), bool)
    out[order] = np.repeat(several, end - start)
    return out & (owners != SEVERAL)
