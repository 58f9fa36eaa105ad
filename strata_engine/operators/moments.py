"""Fits that merge: moments kept per input file.

The statistics that scaling needs (count, mean, sum of squared deviations,
min, max) of a whole are found from those of its parts, so a fit can be saved
as one small row per column and input file. When files come in, only they are
read; when a file changes or goes, its rows are replaced or left out. The
merge is the parallel one (deviations are corrected by how far a part's mean
lies from the common mean), not sums of squares, which lose all digits where
the mean is large against the spread.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata_engine.operators.scale import Fit
from strata_engine.session import fits_broadcast, materialize

SCHEMA = "part string, column_name string, n bigint, mean double, m2 double, min double, max double"


def moments(df: DataFrame, cols: Sequence[str], part: str | None = None, missing: float | None = None) -> DataFrame:
    """One row per part and column: part (the text of the column ``part``;
    without one a single part ''), column_name, n, mean, m2, min, max.

    NULLs do not count, nor ``missing`` (e.g. -9); a part without values has
    n 0 and NULL elsewhere. One aggregate over ``df``; a part that holds most
    of the rows is merged per task before the shuffle."""
    key = F.lit("") if part is None else F.coalesce(F.col(part).cast("string"), F.lit(""))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = x if missing is None else F.when(x != F.lit(float(missing)), x)
        m2 = F.var_pop(x) * F.count(x)  # Spark merges its partial (n, mean, m2) states the same way
        stats = F.struct(F.lit(c).alias("column_name"), F.count(x).alias("n"), F.avg(x).alias("mean"), m2.alias("m2"), F.min(x).alias("min"), F.max(x).alias("max"))
        aggs.append(stats.alias(f"c{i}"))
    if not aggs:
        return df.sparkSession.createDataFrame([], SCHEMA)
    wide = df.groupBy(key.alias("part")).agg(*aggs)
    return wide.select("part", F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cols))])))


def merge(parts: DataFrame) -> DataFrame:
    """One row per column from rows of :func:`moments` (any number of parts):
    column_name, n, mean, stddev (sample), m2, min, max.

    Two passes over the small table: the common mean first, then each part's
    deviations and the distance of its mean."""
    total = parts.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("centre")
    )
    total = total.select(F.col("column_name").alias("whole_column"), "centre")
    total = F.broadcast(total) if fits_broadcast(total) else total
    moved = parts.join(total, F.col("column_name") == F.col("whole_column"))
    # the rest of the mean that rounding has left in the centre
    off = F.sum(F.col("n") * (F.col("mean") - F.col("centre")))
    spread = F.sum(F.coalesce(F.col("m2"), F.lit(0.0)) + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2))
    merged = moved.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.first("centre").alias("centre"), off.alias("off"), spread.alias("spread"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    )
    n = F.col("n")
    m2 = F.greatest(F.col("spread") - F.try_divide(F.col("off") * F.col("off"), n), F.lit(0.0))
    return merged.select(
        "column_name",
        "n",
        (F.col("centre") + F.try_divide(F.col("off"), n)).alias("mean"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("stddev"),
        F.when(n > 0, m2).alias("m2"),
        "min",
        "max",
    )


def to_fit(merged: DataFrame, cols: Sequence[str]) -> Fit:
    """The fit that ``scale(..., fitted=)`` takes, from :func:`merge`: four
    numbers per column come to the driver."""
    wanted = merged.where(F.col("column_name").isin(list(cols)))
    found = {r["column_name"]: r for r in wanted.collect()}
    lacking = [c for c in cols if c not in found]
    if lacking:
        raise KeyError(f"no moments of {lacking}")
    return {c: {"min": found[c]["min"], "max": found[c]["max"], "mean": found[c]["mean"], "sd": found[c]["stddev"]} for c in cols}


class MomentStore:
    """Moments of a growing folder of files, kept as a small table at ``path``.

    ``read`` turns a list of file paths into a frame (it must read files, as
    ``spark.read.parquet(*paths)`` does). An update lists the folder, reads
    the files that are new or have changed (by size or time), and appends
    their rows. A changed file counts with its newest rows, a file that is
    gone not at all. The driver holds one entry per file, as Spark's own file
    listing does."""

    def __init__(
        self, spark: SparkSession, path: str, cols: Sequence[str], read: Callable[[list[str]], DataFrame] | None = None,
        missing: float | None = None,
    ):
        self.spark, self.path, self.cols, self.missing = spark, path.rstrip("/"), list(cols), missing
        self.read = read or (lambda paths: spark.read.parquet(*paths))
        self.last_read: list[str] = []  # files the last update has read

    def _saved(self) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)
        schema = f"{SCHEMA}, size bigint, changed timestamp, update int"
        return self.spark.read.schema(schema).parquet(self.path) if there else self.spark.createDataFrame([], schema)

    def update(self, folder: str, glob: str = "*.parquet") -> DataFrame:
        """Bring the moments up to the files below ``folder`` whose names
        match ``glob``, and return them merged (:func:`merge`)."""
        here = file_states(self.spark, folder, glob)
        saved = self._saved()
        newest = saved.groupBy("part").agg(F.max_by(F.struct("size", "changed"), "update").alias("state"), F.max("update").alias("update"))
        known, number = {}, 1
        for r in newest.collect():
            known[r["part"]], number = (r["state"]["size"], r["state"]["changed"]), max(number, r["update"] + 1)
        fresh = {key: path for key, (path, *state) in here.items() if known.get(key) != tuple(state)}
        self.last_read = sorted(fresh)
        if fresh:
            rows = self.read(sorted(fresh.values()))
            rows = rows.select(_file_key(F.col("_metadata.file_path")).alias("strata_part"), *[f"`{c}`" for c in self.cols])
            states = self.spark.createDataFrame([(k, here[k][1], here[k][2], number) for k in fresh], "file string, size bigint, changed timestamp, update int")
            # a file without rows has no moments, but has been seen: n 0
            none = [F.lit(None).cast("double").alias(c) for c in ("mean", "m2", "min", "max")]
            empty = states.select(F.col("file").alias("part"), F.explode(F.array(*map(F.lit, self.cols))).alias("column_name"), F.lit(0).cast("bigint").alias("n"), *none)
            found = moments(rows, self.cols, "strata_part", self.missing)
            found = found.unionByName(empty).groupBy("part", "column_name").agg(
                *[F.max_by(c, "n").alias(c) for c in ("mean", "m2", "min", "max")], F.max("n").alias("n")
            )
            found = found.join(states, F.col("part") == F.col("file")).select(*saved.columns)
            found.coalesce(1).write.mode("append").parquet(self.path)  # a few rows per new file
            saved = self._saved()
        last = saved.groupBy("part").agg(F.max("update").alias("update"))
        there = self.spark.createDataFrame([(k,) for k in here], "part string")
        current = saved.join(last, ["part", "update"], "left_semi").join(there, "part", "left_semi")
        return merge(materialize(current.select("part", "column_name", "n", "mean", "m2", "min", "max"), "moments"))


def _file_key(path: Column) -> Column:
    return F.regexp_replace(path, "^(\\w+):/+", "$1:/")


def file_states(spark: SparkSession, folder: str, glob: str) -> dict[str, tuple]:
    """{key: (path, size, time of change)} of the files below a folder, from a
    listing; no file is opened. The key is how ``_metadata.file_path`` names
    the file, whatever number of slashes it has after the scheme."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    rows = listed.select("path", "length", "modificationTime").collect()
    return {re.sub(r"^(\w+):/+", r"\1:/", path(r[0]).toUri().toString()): (r[0], r[1], r[2]) for r in rows}
