"""Packing by minimum bin slack.

Only the numbers of pieces per length matter for what goes together, so the
search runs on at most ``capacity`` counts: take the longest length left,
find by a bitset subset-sum over the lengths left the combination that fills
its bin most, and remove that combination as often as the counts allow
before searching again. Which piece goes where then follows from its rank
among the pieces of its length, which is counted in bounded groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, give_back
from strata_engine.session import fits_broadcast, materialize


def fullest(counts: dict[int, int], space: int) -> dict[int, int]:
    """Multiset of available lengths whose sum is the largest that fits into
    ``space``; lengths are offered longest first, and of equal sums the one
    reached with the longer lengths is taken."""
    reach, steps = 1, []  # bit s of reach: sum s can be made
    full = 1 << space
    mask = (full << 1) - 1
    for length in sorted((x for x, n in counts.items() if n > 0 and x <= space), reverse=True):
        left, take = min(counts[length], space // length), 1
        while left and not reach & full:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach & full:
            break
    best, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> best & 1:
            used[length] = used.get(length, 0) + take
            best -= length * take
    return used


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(lengths of a bin, how many such bins)], longest seeds first."""
    left = {x: n for x, n in counts.items() if n > 0}
    bins = []
    while left:
        seed = max(left)
        if seed > capacity:
            raise ValueError(f"a piece of {seed} does not fit into {capacity}")
        rest = {**left, seed: left[seed] - 1}
        used = fullest(rest, capacity - seed)
        used[seed] = used.get(seed, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        bins.append((used, times))
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return bins


def _segments(bins: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, bins of the pattern, first sequence, offset
    of the length's first piece in the bin), by length and rank."""
    rows, taken, sequence = [], {}, 0
    for used, times in bins:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, taken.get(length, 0), times, sequence, offset))
            taken[length] = taken.get(length, 0) + used[length] * times
            offset += length * used[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def rank_by_length(pieces: DataFrame, counts: dict[int, int], group_rows: int) -> DataFrame:
    """Add ``rank`` (0-based, dense per length). A length held by many pieces
    is counted in hashed groups of about ``group_rows``."""
    keys = [c for c in pieces.columns if c != "length"]
    groups = {x: max(1, -(-n // group_rows)) for x, n in counts.items()}
    split = {x: g for x, g in groups.items() if g > 1}  # at most one entry a length
    if split:
        table = F.create_map(*[F.lit(v) for x, g in split.items() for v in (x, g)])
        bucket = F.pmod(F.xxhash64(*keys), F.coalesce(table[F.col("length").cast("int")], F.lit(1)))
    else:
        bucket = F.lit(0)
    grouped = pieces.withColumn("__bucket", bucket.cast("bigint"))
    within = Window.partitionBy("length", "__bucket").orderBy(*keys)
    ranked = grouped.withColumn("rank", F.row_number().over(within).cast("bigint") - 1)
    if split:
        sizes = grouped.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
        before = Window.partitionBy("length").orderBy("__bucket")
        sizes = sizes.select("length", "__bucket", (F.sum("__n").over(before) - F.col("__n")).alias("__before"))
        # about one row for group_rows pieces, and one a length
        sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
        ranked = ranked.join(sizes, ["length", "__bucket"]).withColumn("rank", F.col("rank") + F.col("__before"))
    return ranked.select(*pieces.columns, "rank")


def pack(pieces: DataFrame, capacity: int, group_rows: int = 200_000) -> DataFrame:
    """Columns of ``pieces`` plus ``sequence_id`` and ``offset``.

    ``pieces`` has a column ``length`` (1 to ``capacity``; anything else is
    an error) and columns that tell its rows apart; rows alike in all columns
    may change places. Every sequence holds at most ``capacity`` and is
    filled without gaps from offset 0. No pieces, no rows.
    """
    pieces = materialize(pieces, "pieces")  # read for the counts, the ranks and the result
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where(f"length > {capacity} or length < 1 or n > 0")
    counts = {r["length"]: r["n"] for r in rows.limit(capacity + 1).collect()}
    if any(x is None or not 1 <= x <= capacity for x in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    segments = _segments(plan_bins(counts, capacity))
    ranked = rank_by_length(pieces, counts, group_rows)
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    schema += ", sequence_id bigint, offset bigint"
    target = arrow_schema(schema)

    def place(batches):
        # (length, rank) as one sortable number; ranks stay below 2^50
        starts = (segments[:, 0] << 50) + segments[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            _, first, bins, sequence, offset = segments[np.searchsorted(starts, (length << 50) + rank, "right") - 1].T
            at = rank - first
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).cast(target.field(c).type) for c in names),
                    pa.array(sequence + at % bins, pa.int64()),
                    pa.array(offset + at // bins * length, pa.int64()),
                ],
                schema=target,
            )
        give_back()

    return ranked.mapInArrow(place, schema)
