"""Fitted scaling with native arithmetic.

A fit is ONE aggregate job over the data (partial aggregate per task, a tiny
final merge) for min, max, mean and sample stddev of every column at once;
its four numbers per column come back as the fitted model (as the ML
library's ``fit`` does) and enter the projection as literals. No vector
column, no Python UDF, no join: the transform is one whole-stage-codegen
projection.

Semantics follow the ML-library scalers the original pipeline used:
min-max: (x - min) / (max - min), a constant column gives 0.5;
z-score: (x - mean) / stddev_samp, stddev 0 or undefined gives 0.0.
A NULL input gives NULL (the ML library would fail instead).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.functions.numeric import round_half_away

# Per column min, max, mean and sd (None: undefined), as ``fit`` finds them.
Fit = Mapping[str, Mapping[str, float | None]]

KINDS = ("min_max", "z_score", "min_max_z")


def _value(col: str, missing: float | None) -> Column:
    x = F.col(col).cast("double")
    if missing is not None:
        x = F.when(x == F.lit(float(missing)), F.lit(None).cast("double")).otherwise(x)
    return x


def fit(df: DataFrame, cols: Sequence[str], missing: float | None = None) -> list[dict[str, Column]]:
    """Statistics of all ``cols`` from one aggregate job, as literals."""
    aggs = []
    for i, c in enumerate(cols):
        x = _value(c, missing)
        aggs += [
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"sd{i}"),
        ]
    row = df.agg(*aggs).first() if aggs else None
    return _literals({c: {k: row[f"{k}{i}"] for k in ("min", "max", "mean", "sd")} for i, c in enumerate(cols)}, cols)


def _literals(fitted: Fit, cols: Sequence[str]) -> list[dict[str, Column]]:
    lit = lambda v: F.lit(v).cast("double")  # noqa: E731 - NULL stays typed
    return [{k: lit(fitted[c][k]) for k in ("min", "max", "mean", "sd")} for c in cols]


def _null_if_null(x: Column, value: Column) -> Column:
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(value)


def _min_max_expr(x: Column, s: dict[str, Column]) -> Column:
    span = s["max"] - s["min"]
    return _null_if_null(x, F.when(span == 0, F.lit(0.5)).otherwise(F.try_divide(x - s["min"], span)))


def _z_expr(x: Column, mean: Column, sd: Column, with_mean: bool = True) -> Column:
    centred = x - mean if with_mean else x
    return _null_if_null(x, F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise(F.try_divide(centred, sd)))


def _finish(c: Column, out_type: str, decimals: int | None) -> Column:
    if decimals is not None:
        c = round_half_away(c, decimals)
    return c.cast(out_type)


def scale(
    df: DataFrame,
    cols: Sequence[str],
    kinds: Sequence[str] = ("min_max",),
    norm_suffix: str = "_normalized",
    std_suffix: str = "_standardized",
    out_type: str = "double",
    decimals: int | None = None,
    missing: float | None = None,
    with_mean: bool = True,
    fitted: Fit | None = None,
) -> DataFrame:
    """Add scaled columns for every column and kind, from ONE fit: one
    aggregate over ``df``, or ``fitted`` (e.g. ``moments.to_fit``), which
    takes no job.

    ``min_max`` → ``<col><norm_suffix>``; ``z_score`` (of the raw value) and
    ``min_max_z`` (of the min-max output, the production chain) →
    ``<col><std_suffix>``. ``missing`` (e.g. -9) is treated as NULL.
    """
    bad = set(kinds) - set(KINDS)
    if bad:
        raise ValueError(f"unknown kinds {bad}")
    out = {}
    for c, s in zip(cols, fit(df, cols, missing) if fitted is None else _literals(fitted, cols)):
        x = _value(c, missing)
        span = s["max"] - s["min"]
        norm = _min_max_expr(x, s)
        if "min_max" in kinds or "min_max_z" in kinds:
            out[f"{c}{norm_suffix}"] = _finish(norm, out_type, decimals)
        if "z_score" in kinds:
            out[f"{c}{std_suffix}"] = _finish(_z_expr(x, s["mean"], s["sd"], with_mean), out_type, decimals)
        if "min_max_z" in kinds:
            # For n = (x - min)/span: mean(n) = (mean - min)/span and
            # sd(n) = sd/span, so the second fit needs no second pass.
            n_mean = F.when(span == 0, F.lit(0.5)).otherwise(F.try_divide(s["mean"] - s["min"], span))
            n_sd = F.when(span == 0, F.lit(0.0)).otherwise(F.try_divide(s["sd"], span))
            out[f"{c}{std_suffix}"] = _finish(_z_expr(norm, n_mean, n_sd, with_mean), out_type, decimals)
    return df.withColumns(out)


def min_max(df: DataFrame, cols: Sequence[str], suffix: str = "_normalized", **kw) -> DataFrame:
    """``<col><suffix>`` in [0, 1]; a constant column gives 0.5."""
    return scale(df, cols, ("min_max",), norm_suffix=suffix, **kw)


def z_score(df: DataFrame, cols: Sequence[str], suffix: str = "_standardized", **kw) -> DataFrame:
    """``<col><suffix>`` with mean 0 and sample stddev 1; constant → 0.0."""
    return scale(df, cols, ("z_score",), std_suffix=suffix, **kw)


def min_max_z(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """Min-max, then z-score OF THE MIN-MAX OUTPUT (one fit)."""
    return scale(df, cols, ("min_max_z",), **kw)
