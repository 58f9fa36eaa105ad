"""Integer code → label lookup as one native expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata_engine.functions.literals import map_literal, sql_literal


def code_label(
    col: Column | str,
    mapping: Mapping[object, str],
    default: str | None = "Unknown",
    key_type: DataType | str | None = None,
) -> Column:
    """``mapping.get(col, default)``: a NULL key or a key not in the map gives
    ``default``. The map literal is constant-folded by Catalyst, so this costs
    a search of its keys per row and no Python (long lists: see
    ``transform.map_codes_lookup``).

    ``key_type`` casts the literal keys to the column's type so the lookup
    never casts the column itself. The map is built as one SQL literal
    expression (one parse, not one JVM call per entry).
    """
    col = F.col(col) if isinstance(col, str) else col
    if not mapping:
        return F.lit(default).cast("string")
    kt = key_type if key_type is None or isinstance(key_type, str) else key_type.simpleString()
    table = F.expr(map_literal([(sql_literal(k, kt), sql_literal(v)) for k, v in mapping.items()]))
    looked_up = F.try_element_at(table, col)
    if default is None:
        return looked_up
    return F.coalesce(looked_up, F.lit(default))
