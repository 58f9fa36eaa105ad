"""Session helpers: a local session for tests/bench, shared scratch paths, and
the size bound used before any broadcast."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Conf key (read from the session) for the largest row count we broadcast.
BROADCAST_ROWS_KEY = "strata.broadcast.maxRows"
DEFAULT_BROADCAST_ROWS = 250_000
# ... and for its largest size in bytes (rows are counted with their texts).
BROADCAST_BYTES_KEY = "strata.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 32_000_000


# Key tables up to this many rows become a constant-folded map literal in
# the projection (no join, no broadcast job); plan-building cost grows with
# the number of keys, so larger tables take the broadcast join.
INLINE_KEYS = 128


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "strata_engine") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


# For plans over many columns and rules: Java compiles no method of more than
# 8,000 bytes of code, so longer generated ones would be interpreted for every
# row; and a partitioned save that keeps that many files open in a task need
# not sort its rows (beyond them it sorts the rest). Neither changes a result.
WIDE_CONF = {"spark.sql.codegen.hugeMethodLimit": 8_000, "spark.sql.maxConcurrentOutputFileWriters": 64}
_wide_lock = threading.Lock()
_wide: dict[int, list] = {}  # session -> [runs inside, what was set before]


@contextmanager
def wide_plan(spark: SparkSession) -> Iterator[None]:
    """Actions inside run under ``WIDE_CONF``; a key that the caller has set
    stays as it is, and after the last of several runs all is as before."""
    with _wide_lock:
        held = _wide.setdefault(id(spark), [0, []])
        if not held[0]:
            held[1] = [k for k in WIDE_CONF if spark.conf.get(k, None) is None]
            for k in held[1]:
                spark.conf.set(k, str(WIDE_CONF[k]))
        held[0] += 1
    try:
        yield
    finally:
        with _wide_lock:
            held[0] -= 1
            if not held[0]:
                del _wide[id(spark)]
                for k in held[1]:
                    spark.conf.unset(k)


class NoSharedFolder(RuntimeError):
    pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without one (tests) gets a folder of its
    own; on a cluster a temporary folder would be another one on every
    machine, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/strata_scratch/{spark.sparkContext.applicationId}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under ``scratch_path``: call it when
    no result that reads from there is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a derived table (key counts, per-stratum cuts) once as parquet
    in the shared checkpoint folder and read it back: one job, and the size
    check, the ranking and the join all read the same rows; a lost executor
    does not recompute the aggregate. (``DataFrame.checkpoint`` would run
    the input plan twice: once to count, once to write.)"""
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def broadcast_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_KEY, str(DEFAULT_BROADCAST_ROWS)))


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: text and binary columns by their length, others 8 bytes
    (nested ones by the length of their JSON text)."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.octet_length(c))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(c))))
        else:
            parts.append(F.lit(8))
    return sum((F.coalesce(p, F.lit(0)).cast("bigint") for p in parts), F.lit(16).cast("bigint"))


def _byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_KEY, str(DEFAULT_BROADCAST_BYTES)))


def collect_small(df: DataFrame, limit: int | None = None) -> list | None:
    """Run ``df`` (an aggregate over keys) once and return its rows if there
    are at most ``limit`` (the session broadcast bound) and they are at most
    the session's byte bound, else None.

    This is the build side of a broadcast join, which also passes through
    the driver; it is never used for data whose size is not checked here.
    """
    spark = df.sparkSession
    limit = broadcast_row_limit(spark) if limit is None else limit
    # coalesce(1) keeps Spark from running the limit as incremental "take"
    # jobs; the running sum ends the result at the first row over the bound
    some = df.limit(limit + 1).coalesce(1).withColumn("__bytes", _row_bytes(df))
    rest = Window.partitionBy(F.lit(1)).orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, 0)
    some = some.withColumn("__running", F.sum("__bytes").over(rest))
    some = some.where(F.col("__running") - F.col("__bytes") <= _byte_limit(spark)).drop("__bytes")
    rows = some.collect()
    if len(rows) > limit or (rows and max(r["__running"] for r in rows) > _byte_limit(spark)):
        return None
    return [Row(**{c: r[c] for c in df.columns}) for r in rows]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Size check before a broadcast: at most ``limit`` rows (the session
    bound) and the session's byte bound. ``df`` must already be
    small-by-construction (an aggregate over keys) or written; at most
    ``limit + 1`` rows are looked at."""
    limit = broadcast_row_limit(df.sparkSession) if limit is None else limit
    seen = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return seen["n"] <= limit and (seen["bytes"] or 0) <= _byte_limit(df.sparkSession)
