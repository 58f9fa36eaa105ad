"""Writers: partitioned overwrite of a path or a catalog table.

Partitioned saves cluster the rows by the partition columns first
(``repartition(cols)``, or ``repartition(n, cols)``), so every task writes
into few directories rather than every task into every directory (the
small-file problem of a 5-column partitioning). With AQE on, the shuffle is
a rebalance whose partitions AQE splits or merges by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from strata_engine.session import fits_broadcast, materialize

# Tasks of a salted save; beyond that a task writes several files.
MOST_WRITERS = 100_000


def cluster_for_write(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """The clustering a partitioned save applies (a REBALANCE on the
    partition columns, or ``repartition(n, keys)``), for callers that add
    steps between it and the write."""
    return _clustered(df, partition_by, cluster_by, num_partitions)


def _clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str] | None,
               num_partitions: int | None) -> DataFrame:
    keys = list(cluster_by) if cluster_by is not None else list(partition_by)
    if not keys:
        return df if num_partitions is None else df.repartition(num_partitions)
    if num_partitions is not None:
        return df.repartition(num_partitions, *keys)
    # REBALANCE: AQE sizes the output partitions and splits a hot key
    return df.hint("rebalance", *[F.col(k) for k in keys])


def save_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str = "snappy",
    cluster_by: Sequence[str] | None = None,
    num_partitions: int | None = None,
) -> None:
    out = _clustered(df, partition_by, cluster_by, num_partitions)
    w = out.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# How full a file of a salted save is meant to be; the rest takes up chance.
FILL = 0.8


def save_salted(
    df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int, mode: str = "overwrite", compression: str = "snappy"
) -> None:
    """Partitioned parquet save (by ``keys``) in which no file holds more than
    ``rows_per_file`` rows and a key has about as few files as that allows.

    Key sizes are measured first (a partial aggregate). A key that fits into
    one file is written by one task; a larger one is dealt over as many tasks
    as it needs files, by a hash of the whole row and of the task that read
    it. So the row's way does not depend on the order in which rows come (a
    task that runs again deals them alike), and copies of one row are spread
    as well as the input spreads them. Hot keys are few (each holds more than
    ``rows_per_file`` rows): their table is broadcast after a size check."""
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    counts = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in names.items()]).agg(F.count(F.lit(1)).alias("__n"))
    counts = materialize(counts, "key_sizes")
    full = max(1, int(rows_per_file * FILL))
    hot = counts.where(F.col("__n") > rows_per_file).withColumn("__salts", F.ceil(F.col("__n") / full).cast("bigint"))
    total = counts.agg(F.sum(F.ceil(F.col("__n") / full))).first()[0] or 1
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    spread = df.withColumn("__from", F.spark_partition_id()).join(hot.drop("__n"), same, "left")
    salt = F.pmod(F.xxhash64(*hashed, "__from"), F.coalesce(F.col("__salts"), F.lit(1)))
    spread = spread.withColumn("__salt", salt).repartition(int(min(total, MOST_WRITERS)), *[F.col(f"`{k}`") for k in keys], "__salt")
    out = spread.select(*[f"`{c}`" for c in df.columns])
    out.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)


def save_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
             num_partitions: int | None = None) -> None:
    out = df if num_partitions is None else df.repartition(num_partitions)
    out.write.mode(mode).option("header", str(header).lower()).csv(path)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    path: str | None = None,
    cluster_by: Sequence[str] | None = None,
    num_partitions: int | None = None,
) -> None:
    """``saveAsTable``; ``path`` makes it an external table in a shared folder.
    ``fmt`` is a parameter (e.g. ``delta`` where that jar is present)."""
    out = _clustered(df, partition_by, cluster_by, num_partitions)
    w = out.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
