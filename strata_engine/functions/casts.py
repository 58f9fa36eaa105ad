"""Casts that never raise: Spark 4 runs in ANSI mode, where a plain cast of
``''`` or an out-of-range number fails the job; ``try_cast`` gives NULL.

``try_cast`` reaches NULL on overflow by throwing and catching an exception
per row (about 10 µs each), so a column that overflows often would make a
cast the slowest step of a job. The casts here range-check first and only
call ``try_cast`` for values that fit, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Integral targets and their inclusive bounds.
INT_BOUNDS = {
    "tinyint": (-128, 127),
    "smallint": (-32768, 32767),
    "int": (-2147483648, 2147483647),
}
_ALIASES = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint"}
NUMERIC_SOURCES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _name(t: DataType | str) -> str:
    s = t if isinstance(t, str) else t.simpleString()
    s = s.strip().lower()
    return _ALIASES.get(s, s)


def safe_cast(col: Column | str, to: DataType | str, source_type: str | None = None) -> Column:
    """``try_cast`` with a range check in front when the source type is
    known: numbers outside the target range and strings too long to fit give
    NULL without the exception path. Without ``source_type`` it is a plain
    ``try_cast``."""
    c = _c(col)
    t = _name(to)
    src = _name(source_type) if source_type else None
    if t not in INT_BOUNDS or src is None:
        return c.try_cast(to)
    lo, hi = INT_BOUNDS[t]
    if src in NUMERIC_SOURCES or src.startswith("decimal"):
        # open interval (lo-1, hi+1): fractional values truncate into range
        return F.when((c > F.lit(lo - 1)) & (c < F.lit(hi + 1)), c.try_cast(to))
    if src == "string":
        # up to 18 characters cannot overflow bigint: parse once as bigint,
        # then range-check; longer strings take the plain path
        wide = c.try_cast("bigint")
        return F.when(F.length(c) <= 18, F.when(wide.between(lo, hi), wide.cast(t))).otherwise(c.try_cast(to))
    return c.try_cast(to)


def id_suffix(col: Column | str, start: int = 5, length: int = 10, to: DataType | str = "int") -> Column:
    """Digits ``start..start+length-1`` (1-based) of the identifier as a number.

    ``20210000001`` → ``1`` with the defaults (drops a 4-digit year prefix).
    Too short (empty suffix) or too large for ``to`` → NULL.
    """
    return safe_cast(F.substring(_c(col).cast("string"), start, length), to, "string")


def lossless(col: Column | str, to: DataType | str, source_type: str | None = None) -> Column:
    """TRUE when casting to ``to`` keeps the value; NULL input gives NULL.
    With a numeric ``source_type`` an out-of-range value gives NULL without
    the exception path."""
    c = _c(col)
    return safe_cast(c, to, source_type) == c
