"""SQL literal text for small constant tables (map literals), so a lookup
table becomes ONE expression parsed once instead of one JVM call per value."""

from __future__ import annotations

import datetime
import decimal
import math


def sql_literal(v: object, cast: str | None = None) -> str:
    """Spark SQL text of a Python scalar; ``cast`` wraps it in CAST(.. AS ..)."""
    if v is None:
        text = "NULL"
    elif isinstance(v, bool):
        text = "TRUE" if v else "FALSE"
    elif isinstance(v, int):
        text = f"{v}L" if not -2**31 <= v < 2**31 else str(v)
    elif isinstance(v, float):
        text = repr(v) + "D" if math.isfinite(v) else f"CAST('{v}' AS DOUBLE)"
    elif isinstance(v, str):
        text = "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    elif isinstance(v, decimal.Decimal):
        text = f"CAST('{v}' AS DECIMAL(38, {max(0, -v.as_tuple().exponent)}))"
    elif isinstance(v, datetime.datetime):
        kind = "TIMESTAMP_NTZ" if v.tzinfo is None else "TIMESTAMP"
        text = f"{kind} '{v.isoformat(sep=' ')}'"
    elif isinstance(v, datetime.date):
        text = f"DATE '{v.isoformat()}'"
    else:
        raise TypeError(f"no SQL literal for {type(v).__name__}")
    return f"CAST({text} AS {cast})" if cast else text


def map_literal(pairs: list[tuple[str, str]]) -> str:
    """``map(k1, v1, ...)`` from already rendered key / value texts."""
    return "map(" + ", ".join(f"{k}, {v}" for k, v in pairs) + ")"
