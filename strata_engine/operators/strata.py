"""Stratum keys and the frequency index of a string column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.operators.ranking import dense_index
from strata_engine.functions.codes import code_label
from strata_engine.session import INLINE_KEYS, collect_small, materialize


def strata_expr(cols: Sequence[str], sep: str = "_", null_token: str | None = None):
    parts = [F.col(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.concat_ws(sep, *parts)


def add_strata(
    df: DataFrame,
    cols: Sequence[str],
    out: str = "demographic_strata",
    sep: str = "_",
    null_token: str | None = None,
) -> DataFrame:
    """``out = concat_ws(sep, cols...)``. NULL inputs are skipped (never a
    NULL key), so (1,NULL,2) and (1,2,NULL) collide unless ``null_token`` is
    given, which stands in for NULL."""
    return df.withColumn(out, strata_expr(cols, sep, null_token))


ESCAPE = "\\"
NULL_PART = ESCAPE + "N"


def exact_strata_expr(cols: Sequence[str], sep: str = "_") -> Column:
    """A stratum key from which its parts can be told again: inside a part
    the separator and the escape sign are escaped, NULL is ``\\N``. Different
    parts always give different keys, also where values hold the separator."""
    if len(sep) != 1 or sep in (ESCAPE, "N"):
        raise ValueError("the separator must be one character, neither a backslash nor N")
    if not cols:
        raise ValueError("a stratum needs at least one column")
    parts = []
    for c in cols:
        text = F.replace(F.col(c).cast("string"), F.lit(ESCAPE), F.lit(ESCAPE * 2))
        text = F.replace(text, F.lit(sep), F.lit(ESCAPE + sep))
        parts.append(F.coalesce(text, F.lit(NULL_PART)))
    return F.concat_ws(sep, *parts)


def add_exact_strata(df: DataFrame, cols: Sequence[str], out: str = "demographic_strata", sep: str = "_") -> DataFrame:
    """``out``: the key of :func:`exact_strata_expr`. Keys of values without
    separator, backslash or NULL are those of :func:`add_strata`."""
    return df.withColumn(out, exact_strata_expr(cols, sep))


def split_strata(df: DataFrame, key: str, names: Sequence[str], sep: str = "_") -> DataFrame:
    """Add the parts of an exact key as text columns ``names`` (NULL where a
    part was NULL, and where the key has no such part)."""
    quoted = re.escape(sep)
    each = f"(?s){quoted}((?:\\\\.|[^\\\\{quoted}])*)"
    parts = F.regexp_extract_all(F.concat(F.lit(sep), F.col(key)), F.lit(each), F.lit(1))
    out = {}
    for i, name in enumerate(names):
        part = F.get(parts, F.lit(i))
        out[name] = F.when(part != NULL_PART, F.regexp_replace(part, r"(?s)\\(.)", "$1"))
    return df.withColumns(out)


class NullLabel(ValueError):
    pass


def value_counts(df: DataFrame, col: str) -> dict | DataFrame:
    """Rows per value of ``col`` (NULL included) — one partial aggregate — as
    ``{value: n}`` when its size is under the session bound, else as a table
    (``__label``, ``__n``) written once. :func:`frequency_index` takes both,
    so several indexes of one column share a count."""
    counts = df.groupBy(F.col(col).alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
    rows = collect_small(counts)
    return materialize(counts, "labels") if rows is None else {r["__label"]: int(r["__n"]) for r in rows}


def frequency_index(
    df: DataFrame,
    col: str,
    out: str = "strataIndex",
    on_null: str = "error",
    counts: dict | DataFrame | None = None,
) -> DataFrame:
    """Index of each value by frequency: the most frequent value gets 0.0,
    ties go to the alphabetically first value (the ML ``StringIndexer``
    order), as a double.

    Counting is a partial aggregate (a hot value is merged per task before
    the shuffle). When the label table (one row per distinct value) is under
    the session bound, it is ranked like the ML indexer's fit and broadcast
    back (one job); beyond that it is written once, ranked across tasks
    (:func:`dense_index`) and shuffle-joined, with AQE splitting hot values
    on the big side.

    ``on_null``: ``error`` raises if the column has NULLs (as the ML
    indexer); ``keep`` gives NULL rows the index ``number of labels``;
    ``skip`` drops NULL rows. ``counts`` ({value: n} from
    :func:`value_counts` on a string column) skips the counting job.
    """
    spark = df.sparkSession
    key = F.col(col).cast("string")
    stored = counts if isinstance(counts, DataFrame) and dict(df.dtypes)[col] == "string" else None
    if stored is not None:
        rows = None
    elif isinstance(counts, dict) and dict(df.dtypes)[col] == "string":
        rows = [{"__label": k, "__n": v} for k, v in counts.items()]
    else:
        counts = df.groupBy(key.alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
        rows = collect_small(counts)
    if rows is not None:
        # bounded label table: rank it as the ML indexer's fit does
        has_null = any(r["__label"] is None for r in rows)
        labels = sorted((r for r in rows if r["__label"] is not None), key=lambda r: (-r["__n"], r["__label"]))
        n_labels = len(labels)
        if n_labels <= INLINE_KEYS:
            # a handful of labels: a map literal in the projection, no join
            lookup = code_label(key, {r["__label"]: float(i) for i, r in enumerate(labels)}, None, "string")
            lookup = lookup.cast("double")  # typed even with no labels
            return _finish_index(df, col, out, lookup, has_null, n_labels, on_null)
        ranked = F.broadcast(spark.createDataFrame(
            [(r["__label"], float(i)) for i, r in enumerate(labels)], "__label string, __idx double"
        ))
    else:
        stored = materialize(counts, "labels") if stored is None else stored
        has_null = stored.filter(F.col("__label").isNull()).limit(1).count() > 0
        labels_df = stored.filter(F.col("__label").isNotNull())
        n_labels = labels_df.count()
        ranked = dense_index(labels_df, [F.col("__n").desc(), F.col("__label").asc()], "__idx", small=False)
        ranked = ranked.select("__label", F.col("__idx").cast("double").alias("__idx"))
    joined = df.join(ranked, key == ranked["__label"], "left")
    return _finish_index(joined, col, out, F.col("__idx"), has_null, n_labels, on_null).drop("__label", "__idx")


def _check_nulls(col: str, has_null: bool, on_null: str) -> None:
    if on_null not in ("error", "keep", "skip"):
        raise ValueError("on_null must be error, keep or skip")
    if on_null == "error" and has_null:
        raise NullLabel(f"column {col!r} has NULL values")


def _finish_index(df: DataFrame, col: str, out: str, idx, has_null: bool, n_labels: int, on_null: str) -> DataFrame:
    _check_nulls(col, has_null, on_null)
    if on_null == "skip":
        df = df.filter(F.col(col).isNotNull())
    if on_null == "keep":
        idx = F.when(F.col(col).isNull(), F.lit(float(n_labels))).otherwise(idx)
    return df.withColumn(out, idx)
