"""Train / validation / test splits.

* :func:`random_split`, :func:`three_way` – the ``randomSplit`` form (depends
  on the partition layout; kept for API parity).
* :func:`random_split_column` – one pass, a seeded ``rand`` per row.
* :func:`hash_split` – per-row key hash: layout-independent, no shuffle,
  approximate shares.
* :func:`stratified_split` – exact shares per stratum: the rows of each
  stratum are ordered by the key hash and cut at rounded cumulative weights;
  only the boundary rows are searched for, among few candidates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata_engine.functions.hashing import hash_hex, unit_hash
from strata_engine.session import collect_small, fits_broadcast, materialize

DEFAULT_WEIGHTS = (0.6, 0.2, 0.2)
DEFAULT_NAMES = ("train", "validation", "test")


def _cuts(weights: Sequence[float]) -> list[float]:
    total = float(sum(weights))
    acc, cuts = 0.0, []
    for w in weights[:-1]:
        acc += w
        cuts.append(acc / total)
    return cuts


def _label(arm: Column, names: Sequence[str]) -> Column:
    expr = F.when(arm == 0, F.lit(names[0]))
    for i, n in enumerate(names[1:], start=1):
        expr = expr.when(arm == i, F.lit(n))
    return expr


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """``DataFrame.randomSplit``: same rows only for the same partition layout."""
    return df.randomSplit(list(weights), seed=seed)


def three_way(df: DataFrame, seed: int = 42) -> dict[str, DataFrame]:
    """The nested split 0.8/0.2, then the 0.8 part 0.75/0.25 → 60/20/20."""
    train, test = df.randomSplit([0.8, 0.2], seed=seed)
    train, validation = train.randomSplit([0.75, 0.25], seed=seed)
    return {"train": train, "validation": validation, "test": test}


def random_split_column(
    df: DataFrame,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    names: Sequence[str] = DEFAULT_NAMES,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """One pass: ``out`` from a seeded uniform draw per row (layout-dependent
    like ``randomSplit``, but the input is read once, not once per arm)."""
    # draw once into a column: a rand() repeated inside CASE branches would
    # advance separately per branch and give inconsistent draws
    drawn = df.withColumn("__u", F.rand(seed))
    arm = sum((F.col("__u") >= F.lit(c)).cast("int") for c in _cuts(weights))
    return drawn.withColumn(out, _label(arm, names)).drop("__u")


def hash_split(
    df: DataFrame,
    key_cols: Sequence[str],
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    names: Sequence[str] = DEFAULT_NAMES,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """``out`` from the key hash in [0, 1) against the cumulative weights.
    Row-local: no shuffle, identical on any layout, engine or re-run."""
    u = unit_hash(key_cols, seed)
    expr = None
    for c, n in zip(_cuts(weights), names):
        expr = F.when(u < F.lit(c), F.lit(n)) if expr is None else expr.when(u < F.lit(c), F.lit(n))
    expr = expr.otherwise(F.lit(names[len(weights) - 1])) if expr is not None else F.lit(names[0])
    return df.withColumn(out, expr)


# Hex digits of the key hash that each counting round adds.
ROUND_DIGITS = (2, 3)
HASH_DIGITS = 32


def stratified_split(
    df: DataFrame,
    strata_col: str,
    key_cols: Sequence[str],
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    names: Sequence[str] = DEFAULT_NAMES,
    seed: int = 42,
    out: str = "split",
    target_rows: int = 100_000,
) -> DataFrame:
    """Exact stratified split.

    Definition: in a stratum of n rows ordered by ``md5(seed-key)`` then the
    key, row number rn goes to arm i when it is at most
    ``floor(cum_weight_i * n + 0.5)`` and above the previous cut (strata of
    1, 2, 3, 4 rows at 60/20/20 give 1/0/0, 1/1/0, 2/0/1, 2/1/1). Rows alike
    in all key columns go to the same arm, that of the first of them. NULL
    strata form a stratum.

    Plan: the last row of each arm (the boundary) is selected per stratum,
    then one pass over ``df`` compares every row with its stratum's
    boundaries. The selection reads ``df`` twice, stratum and key columns
    only, however many rounds it takes:

    1. Rows are counted per stratum and leading hash digits (a partial
       aggregate, at most 256 rows per stratum from each task). The counts
       tell the bucket that holds each cut, and how far into it.
    2. The rows of those buckets (about cuts / 256 of the table) are the
       candidates. If no bucket has more than ``target_rows`` of them they
       are ranked at once; else they are written, and rounds of counting by
       three more digits narrow the buckets on what was written.

    Counts and boundaries stay local when their size is under the session
    bound, else they are written and joined; only beyond the bound for the
    boundaries ``df`` is shuffled.
    """
    cuts = _cuts(weights)
    keys = [f"__k{i}" for i in range(len(key_cols))]
    narrow = df.select(
        F.col(strata_col).alias("__s"),
        hash_hex(key_cols, seed).alias("__h"),
        *[F.col(c).alias(k) for c, k in zip(key_cols, keys)],
    )
    narrow, buckets, rows, digits = _cut_buckets(narrow, cuts, target_rows)
    if rows is not None and max((r[4] for r in rows), default=0) <= target_rows:  # local, bounded buckets
        bounds = F.broadcast(_local_boundaries(narrow, rows, keys, len(cuts), digits))
    else:
        bounds, small = _settled(_boundaries(narrow, buckets, keys, len(cuts), digits), "strata_bounds")
        bounds = F.broadcast(bounds) if small is not None else bounds
    # left: a row is never dropped; a cut without boundary lies before all rows
    joined = df.join(bounds, F.col(strata_col).eqNullSafe(bounds["__s"]), "left")
    position = F.struct(hash_hex(key_cols, seed).alias("__h"), *[F.col(c).alias(k) for c, k in zip(key_cols, keys)])
    arm = sum((F.coalesce(position > F.col(f"__b{i}"), F.lit(True)).cast("int") for i in range(len(cuts))), F.lit(0))
    return joined.withColumn(out, _label(arm, names)).select(*[c for c in df.columns if c != out], out)


def _settled(df: DataFrame, name: str) -> tuple[DataFrame, list | None]:
    """``df`` computed once: a local table and its rows when its size is under
    the session bound, else a written table and None."""
    rows = collect_small(df)
    if rows is None:
        return materialize(df, name), None
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], df.schema), rows


def _cut_buckets(narrow: DataFrame, cuts: list[float], target_rows: int) -> tuple[DataFrame, DataFrame | None, list | None, int]:
    """The rows among which the boundaries are (``narrow`` itself, or the
    candidates of it, written), one row per stratum and cut that lies behind
    some row: __cut, the hash prefix of the rows around it (__p), how many
    rows of that prefix come up to it (__want), and how many there are
    (__c), as a table, as local rows, or both; and the prefix's length."""
    digits = ROUND_DIGITS[0]
    counts = narrow.groupBy("__s", F.substring("__h", 1, digits).alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    rows = collect_small(counts)
    if rows is not None:
        rows = _local_buckets(rows, cuts)
        if max((r[4] for r in rows), default=0) <= target_rows:
            return narrow, None, rows, digits
        buckets = narrow.sparkSession.createDataFrame(rows, _bucket_schema(narrow))
    else:
        buckets, rows = _settled(_buckets(materialize(counts, "strata_counts"), cuts), "strata_buckets")
    narrowed = False
    while digits < HASH_DIGITS:
        largest = buckets.agg(F.max("__c")).first()[0] or 0 if rows is None else max((r[4] for r in rows), default=0)
        if largest <= target_rows:
            break
        if not narrowed:
            narrow, narrowed = materialize(_rows_of(narrow, buckets, digits).drop("__p"), "strata_candidates"), True
        finer = min(HASH_DIGITS, digits + ROUND_DIGITS[1])
        counts = _rows_of(narrow, buckets, digits).groupBy(
            "__s", "__p", F.substring("__h", 1, finer).alias("__q")
        ).agg(F.count(F.lit(1)).alias("__d"))
        upto = F.sum("__d").over(Window.partitionBy("__s", "__p").orderBy("__q"))
        counts = counts.withColumn("__before", upto - F.col("__d"))
        counts = counts.withColumnsRenamed({"__s": "__s2", "__p": "__p2"})
        buckets = buckets.join(
            counts,
            F.col("__s").eqNullSafe(F.col("__s2")) & (F.col("__p") == F.col("__p2"))
            & (F.col("__want") > F.col("__before")) & (F.col("__want") <= F.col("__before") + F.col("__d")),
        ).select(
            "__s", "__cut", F.col("__q").alias("__p"), (F.col("__want") - F.col("__before")).alias("__want"), F.col("__d").alias("__c")
        )
        (buckets, rows), digits = _settled(buckets, "strata_buckets"), finer
    return narrow, buckets, rows, digits


def _bucket_schema(narrow: DataFrame) -> StructType:
    more = StructType.fromDDL("__cut int, __p string, __want bigint, __c bigint")
    return StructType([StructField("__s", narrow.schema["__s"].dataType), *more.fields])


def _local_buckets(counts: list, cuts: list[float]) -> list[tuple]:
    """Rows (__s, __cut, __p, __want, __c) from counts on the driver."""
    by_stratum: dict = {}
    for r in counts:
        by_stratum.setdefault(r["__s"], []).append((r["__p"], r["__c"]))
    out = []
    for stratum, held in by_stratum.items():
        held.sort()
        n = sum(c for _, c in held)
        places = iter([(i, at) for i, c in enumerate(cuts) if 0 < (at := math.floor(c * n + 0.5))])
        cut, before = next(places, None), 0
        for prefix, c in held:
            while cut is not None and cut[1] <= before + c:
                out.append((stratum, cut[0], prefix, cut[1] - before, c))
                cut = next(places, None)
            before += c
    return out


def _buckets(counts: DataFrame, cuts: list[float]) -> DataFrame:
    """The same from a table of counts beyond the session bound."""
    within = Window.partitionBy("__s")
    upto = F.sum("__c").over(within.orderBy("__p"))
    places = F.array(*[
        F.struct(F.lit(i).alias("cut"), F.floor(F.lit(c) * F.col("__n") + F.lit(0.5)).alias("at")) for i, c in enumerate(cuts)
    ]) if cuts else F.array().cast("array<struct<cut:int,at:bigint>>")
    found = counts.select("__s", "__p", "__c", (upto - F.col("__c")).alias("__before"), F.sum("__c").over(within).alias("__n"))
    found = found.select("__s", "__p", "__c", "__before", F.explode(places).alias("__at"))
    found = found.where((F.col("__at.at") > F.col("__before")) & (F.col("__at.at") <= F.col("__before") + F.col("__c")))
    return found.select(
        "__s", F.col("__at.cut").alias("__cut"), "__p", (F.col("__at.at") - F.col("__before")).alias("__want"), "__c"
    )


def _rows_of(narrow: DataFrame, buckets: DataFrame, digits: int) -> DataFrame:
    """The rows of ``narrow`` in any of the buckets, with their prefix __p."""
    wanted = buckets.select(F.col("__s").alias("__s1"), F.col("__p").alias("__p1")).distinct()
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    rows = narrow.withColumn("__p", F.substring("__h", 1, digits))
    return rows.join(wanted, F.col("__s").eqNullSafe(F.col("__s1")) & (F.col("__p") == F.col("__p1")), "left_semi")


def _local_boundaries(narrow: DataFrame, buckets: list, keys: list[str], n_cuts: int, digits: int) -> DataFrame:
    """As :func:`_boundaries`, for buckets on the driver that hold a bounded
    number of rows each: a bucket's positions are sorted as one array."""
    spark = narrow.sparkSession
    wants: dict = {}
    for stratum, cut, prefix, want, _ in buckets:
        wants.setdefault((stratum, prefix), []).append((cut, want))
    stratum = narrow.schema["__s"]
    schema = StructType([
        StructField("__s1", stratum.dataType), *StructType.fromDDL("__p1 string, __wants array<struct<cut:int,want:int>>").fields
    ])
    wanted = F.broadcast(spark.createDataFrame([(s, p, w) for (s, p), w in wants.items()], schema))
    rows = narrow.withColumn("__p", F.substring("__h", 1, digits)).join(
        wanted, F.col("__s").eqNullSafe(F.col("__s1")) & (F.col("__p") == F.col("__p1"))
    )
    sorted_rows = rows.groupBy("__s", "__p").agg(
        F.array_sort(F.collect_list(F.struct("__h", *keys))).alias("__at"), F.first("__wants").alias("__wants")
    )
    found = sorted_rows.select("__s", "__at", F.explode("__wants").alias("__w"))
    found = found.select("__s", F.col("__w.cut").alias("__cut"), F.element_at("__at", F.col("__w.want")).alias("__b"))
    bounds: dict = {}
    for r in found.collect():  # at most one row per bucket given
        bounds.setdefault(r["__s"], [None] * n_cuts)[r["__cut"]] = r["__b"]
    fields = [StructField(f"__b{i}", found.schema["__b"].dataType) for i in range(n_cuts)]
    return spark.createDataFrame([(s, *b) for s, b in bounds.items()], StructType([StructField("__s", stratum.dataType), *fields]))


def _boundaries(narrow: DataFrame, buckets: DataFrame, keys: list[str], n_cuts: int, digits: int) -> DataFrame:
    """One row per stratum: __s and, per cut, the position (hash, keys) of
    the last row before it (__b0, ...); no row for a stratum without any."""
    rows = _rows_of(narrow, buckets, digits)
    position = F.struct("__h", *keys)
    ranked = rows.select("__s", "__p", position.alias("__at")).withColumn(
        "__rn", F.row_number().over(Window.partitionBy("__s", "__p").orderBy("__at"))
    ).withColumnsRenamed({"__s": "__s2", "__p": "__p2"})
    hit = buckets.join(
        ranked, F.col("__s").eqNullSafe(F.col("__s2")) & (F.col("__p") == F.col("__p2")) & (F.col("__want") == F.col("__rn"))
    )
    found = [F.max(F.when(F.col("__cut") == i, F.col("__at"))).alias(f"__b{i}") for i in range(n_cuts)]
    return hit.groupBy("__s").agg(F.count(F.lit(1)).alias("__cuts"), *found).drop("__cuts")


def save_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One table for all splits, partitioned by the split column; reading a
    split back is partition pruning (see :func:`read_split`)."""
    df.write.format(fmt).mode(mode).partitionBy(split_col).save(path)


def read_split(spark, path: str, name: str, split_col: str = "split", fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).filter(F.col(split_col) == F.lit(name))
