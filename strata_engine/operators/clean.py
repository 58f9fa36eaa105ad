"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """Drop rows with a NULL in any (or, ``how="all"``, every) listed column;
    all columns when ``subset`` is None. A filter, so it is pushed to the scan."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names not present are ignored (as ``DataFrame.drop``)."""
    return df.drop(*cols)
