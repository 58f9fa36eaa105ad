"""Seeded, layout-independent hashes of a row key.

The hash is ``md5(seed || '-' || key)`` (key columns joined with ``-``); its
first 8 hex digits read as an unsigned 32-bit number and divided by 2^32 give
a value in [0, 1). The same recipe is plain SQL in any engine, so splits can
be recomputed outside Spark and do not move when the data is repartitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _keys(key_cols: Sequence[str | Column]) -> list[Column]:
    return [(F.col(k) if isinstance(k, str) else k).cast("string") for k in key_cols]


def hash_hex(key_cols: Sequence[str | Column], seed: int | str = 42) -> Column:
    """32 lowercase hex digits; orders rows pseudo-randomly but reproducibly."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *_keys(key_cols)))


def hex_prefix_value(hex_col: Column, digits: int) -> Column:
    """First ``digits`` hex digits as a non-negative bigint."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


def unit_hash(key_cols: Sequence[str | Column], seed: int | str = 42) -> Column:
    """Uniform value in [0, 1) from the key."""
    return hex_prefix_value(hash_hex(key_cols, seed), 8) / F.lit(TWO_POW_32)
