"""Column profiles, previews and grouped summaries — each is ONE aggregate
over the data (partial per task), unpivoted afterwards, instead of one job
per column and statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.functions.numeric import round_half_away


def _round(c: Column, decimals: int | None) -> Column:
    return round_half_away(c, decimals) if decimals is not None else c


def _long_form(
    df: DataFrame, cols: Sequence[str], stats: dict[str, callable], decimals: int | None, exact: bool = False
) -> DataFrame:
    names = list(stats)
    aggs = []
    for i, c in enumerate(cols):
        for j, (name, fn) in enumerate(stats.items()):
            value = fn(F.col(c))  # in the column's own type
            aggs.append((value if name == "count" else value.cast("double")).alias(f"__{i}_{j}"))
            if exact and name in ("min", "max"):
                aggs.append(value.cast("string").alias(f"__{i}_{len(names) + (name == 'max')}"))
    wide = df.agg(*aggs)
    names += ["min_exact", "max_exact"] if exact else []
    rows = []
    for i, c in enumerate(cols):
        esc = c.replace("'", "\\'")
        rows.append(f"{i}, '{esc}', " + ", ".join(f"`__{i}_{j}`" for j in range(len(names))))
    stacked = wide.select(
        F.expr(f"stack({len(cols)}, {', '.join(rows)}) AS (position, column_name, {', '.join(names)})")
    )
    out = [F.col("position").cast("int").alias("position"), "column_name"]
    for n in names:
        out.append(F.col(n) if n == "count" or n.endswith("_exact") else _round(F.col(n).cast("double"), decimals).alias(n))
    return stacked.select(*out)


def summarize(df: DataFrame, cols: Sequence[str], decimals: int | None = None, exact: bool = False) -> DataFrame:
    """(position, column_name, min, max, mean, stddev) per column, as doubles;
    stddev is the sample one. ``exact`` adds min_exact and max_exact, the
    extremes as text in the column's own type (a bigint beyond 2^53 has no
    double of its own)."""
    return _long_form(
        df,
        cols,
        {
            "min": F.min,
            "max": F.max,
            "mean": lambda c: F.avg(c.cast("double")),
            "stddev": lambda c: F.stddev_samp(c.cast("double")),
        },
        decimals,
        exact,
    )


def describe(
    df: DataFrame, cols: Sequence[str] | None = None, decimals: int | None = None, exact: bool = False
) -> DataFrame:
    """The ``describe()`` profile (count, mean, stddev, min, max) for numeric
    columns, numeric-typed and long-form rather than strings; ``exact`` as in
    :func:`summarize`."""
    if cols is None:
        numeric = ("int", "bigint", "smallint", "tinyint", "float", "double")
        cols = [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return _long_form(
        df,
        cols,
        {
            "count": lambda c: F.count(c),
            "mean": lambda c: F.avg(c.cast("double")),
            "stddev": lambda c: F.stddev_samp(c.cast("double")),
            "min": F.min,
            "max": F.max,
        },
        decimals,
        exact,
    )


def describe_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The ``describe()`` profile of string columns: (position, column_name,
    count, min, max), min / max in binary string order; one aggregate."""
    if cols is None:
        cols = [c for c, t in df.dtypes if t == "string"]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"__{i}_0"), F.min(c).alias(f"__{i}_1"), F.max(c).alias(f"__{i}_2")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        esc = c.replace("'", "\\'")
        rows.append(f"{i}, '{esc}', `__{i}_0`, `__{i}_1`, `__{i}_2`")
    stacked = wide.select(F.expr(f"stack({len(cols)}, {', '.join(rows)}) AS (position, column_name, count, min, max)"))
    return stacked.select(F.col("position").cast("int").alias("position"), "column_name", "count", "min", "max")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 10) -> DataFrame:
    """First ``n`` rows in a fixed order: a distributed top-k (each task keeps
    n rows), never a full sort."""
    return df.orderBy(*order_by).limit(n)


def group_summary(
    df: DataFrame,
    by: Sequence[str | Column],
    value_cols: Sequence[str] = (),
    decimals: int | None = None,
) -> DataFrame:
    """Per group: n_rows, and avg/min/max of each value column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in value_cols:
        aggs += [
            _round(F.avg(F.col(c).cast("double")), decimals).alias(f"avg_{c}"),
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
        ]
    return df.groupBy(*by).agg(*aggs)
