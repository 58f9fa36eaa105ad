"""Consecutive 0-based positions in a global order, without sending an
unbounded set through one task.

Small inputs (checked: at most the session broadcast bound) use one
``row_number()`` window, which is a single task over a bounded set. Larger
ones are range-sorted across all tasks; each row's position is its rank
inside its sorted partition plus the row count of all earlier partitions.
The sorted set, with its partition ids, is written once to the shared
checkpoint folder, so the per-partition counts and the positions read the
same layout even if a task is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata_engine.session import fits_broadcast, materialize


def dense_index(df: DataFrame, order: Sequence[Column], out: str = "index", small: bool | None = None) -> DataFrame:
    """Add ``out`` (bigint, 0-based) following ``order``; ``order`` must be a
    total order (ties broken by a unique key) for a deterministic result."""
    if small is None:
        small = fits_broadcast(df)
    if small:
        return df.withColumn(out, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    sorted_df = materialize(
        df.orderBy(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()),
        "dense_index",
    )
    # monotonically_increasing_id = (partition << 33) + row-in-partition
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    sizes = sorted_df.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: bounded by the partition count, not the data
    offsets = sizes.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"),
    )
    return (
        sorted_df.join(F.broadcast(offsets), "__pid")
        .withColumn(out, (F.col("__off") + local).cast("bigint"))
        .drop("__pid", "__mid", "__off")
    )


def running_sum(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, out: str = "upto", small: bool | None = None
) -> DataFrame:
    """Add ``out``, the sum of ``value`` over the rows of the same ``by`` up
    to and with this one in ``order`` (a total order within ``by``).

    ``df`` should be written already; it is read twice. Few rows (checked)
    take one window. More are range-sorted over all tasks: a task sums its
    own rows, and what earlier tasks hold of the same ``by`` is added."""
    if small is None:
        small = fits_broadcast(df)
    if small:
        return df.withColumn(out, F.sum(value).over(Window.partitionBy(*by).orderBy(*order)))
    sorted_df = materialize(df.orderBy(*by, *order).withColumn("__pid", F.spark_partition_id()), "running_sum")
    within = Window.partitionBy("__pid", *by)
    # one row per task and group that it holds a part of
    sums = sorted_df.groupBy("__pid", *by).agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy(*by).orderBy("__pid")) - F.col("__sum")
    sums = materialize(sums.withColumn("__before", before).drop("__sum"), "task_sums")
    names = {c: f"__by{i}" for i, c in enumerate(["__pid", *by])}
    sums = sums.withColumnsRenamed(names)
    sums = F.broadcast(sums) if fits_broadcast(sums) else sums
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    own = F.sum(value).over(within.orderBy(*order))
    return (
        sorted_df.withColumn(out, own).join(sums, same).withColumn(out, F.col(out) + F.col("__before"))
        .drop("__pid", "__before", *names.values())
    )
