"""Helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Texts of a batch handled at once inside a task; bounds what a Python
# worker holds besides the Arrow batch itself.
SLICE_BYTES = 1_000_000
# Rows of an Arrow batch.
TEXT_BATCH_ROWS = 1_000


def give_back() -> None:
    """Return freed memory to the system. Python workers are used again by
    later tasks; without this an idle one keeps the most it ever needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


# What a worker keeps between tasks of one operator: {operator: clear it}.
_kept: dict[str, Callable[[], None]] = {}


def keeps(owner: str, clear: Callable[[], None]) -> None:
    _kept[owner] = clear


def begin(owner: str = "") -> None:
    """Call at the start of a task: what other operators' tasks have left in
    this worker goes, so their caches do not add up along a pipeline."""
    for other, clear in _kept.items():
        if other != owner:
            clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower (never raise) the session's Arrow batch size. Rows here are whole
    documents: a batch of 10,000 would be tens of MB, held several times over
    by every task and its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Keep only ``columns`` (new name = old name): extra columns of the
    caller's table, whatever their names, never meet our own. Every operator
    starts here, so here the batch size is lowered, too."""
    small_batches(df.sparkSession)
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in columns.items()])


def text_bytes(column: str) -> Column:
    """UTF-8 bytes of a text column (null stays null)."""
    return F.col(column).cast("string").cast("binary")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``size`` bytes of ``column``; a
    row larger than that forms a slice of its own."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    schema: str,
    make: Callable[[], Callable[[list], Sequence[Sequence]]],
    owner: str = "",
) -> DataFrame:
    """Apply a per-task function to the texts of ``df``, no shuffle.

    ``make()`` runs once per task and returns ``f(texts) -> [values, ...]``,
    one list per column of ``schema`` (which names the new columns only);
    ``keep`` columns pass through as Arrow, so ids of any type, nulls
    included, come out as they went in. ``text`` must be binary or string;
    it is given to ``f`` as Python bytes or str, None for null.
    """
    picked = df.select(*keep, text)
    keep = picked.columns[: len(keep)]
    kept_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keep)])
    out_schema = f"{kept_schema}, {schema}" if keep else schema

    target = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        f = make()
        for batch in batches:
            for part in slices(batch, text):
                made = f(part.column(text).to_pylist())
                columns = [part.column(c).cast(target.field(c).type) for c in keep]
                columns += [pa.array(v, type=target.field(len(keep) + i).type) for i, v in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=target)
        give_back()

    return picked.mapInArrow(run, out_schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def filter_texts(df: DataFrame, text: str, make: Callable[[], Callable[[list], Sequence]], binary: bool = False) -> DataFrame:
    """The rows of ``df``, all columns as they are, for whose texts the
    per-task function gives true; no join, no shuffle."""
    small_batches(df.sparkSession)
    copy, verdict = free_name(df, "text_copy"), free_name(df, "verdict")
    kind = F.col(f"`{text}`").cast("string")
    with_copy = df.withColumn(copy, kind.cast("binary") if binary else kind)

    def wrapped():
        f = make()
        return lambda texts: [f(texts)]

    judged = map_texts(with_copy, [f"`{c}`" for c in df.columns], copy, f"`{verdict}` boolean", wrapped)
    return judged.where(F.col(verdict)).drop(verdict)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, the same ones on every run and
    layout: those with the smallest hash of ``key``."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(rows)


# Bytes of text that a training sample may have.
SAMPLE_BYTES = 64_000_000


def sample_keys(df: DataFrame, key: str, text: str, rows: int, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The keys of a training sample: at most ``rows`` of those with the
    smallest hashes, leaving out any whose texts would take the sample over
    ``max_bytes``. Only keys and sizes come to the driver."""
    sizes = df.groupBy(key).agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0))).alias("size"))
    kept, held = [], 0
    for r in bounded_sample(sizes.where(F.col(key).isNotNull()), key, rows).collect():
        if held + r["size"] <= max_bytes:
            kept.append((r[key],))
            held += r["size"]
    return df.sparkSession.createDataFrame(kept, f"`{key}` {df.schema[key].dataType.simpleString()}")


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus))
