"""Column transforms: code maps, identifier suffixes, casts. Every function
adds or replaces columns in a single projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.functions.casts import id_suffix as id_suffix_expr
from strata_engine.functions.casts import safe_cast
from strata_engine.functions.codes import code_label
from strata_engine.functions.literals import map_literal, sql_literal
from strata_engine.session import broadcast_row_limit, fits_broadcast


# Largest code list applied as a map literal. Such a map is searched key by
# key, so longer lists go through a hash join; both take the same key types.
MAP_LITERAL_MAX = 64


class AmbiguousCode(ValueError):
    """A lookup table gives one code several labels."""


def map_codes(
    df: DataFrame,
    mappings: Mapping[str, Mapping[object, str]],
    suffix: str = "_mapped",
    default: str | None = "Unknown",
) -> DataFrame:
    """For each ``{column: {code: label}}`` add ``<column><suffix>`` with the
    label; a code not in the map, or NULL, gives ``default``. One projection,
    no Python UDF: the map literal is folded into the generated code. Code
    lists longer than ``MAP_LITERAL_MAX`` use :func:`map_codes_lookup`
    (a broadcast join with the driver-built list) instead."""
    types = dict(df.dtypes)
    small = {c: m for c, m in mappings.items() if len(m) <= MAP_LITERAL_MAX}
    out = df.withColumns(
        {f"{c}{suffix}": code_label(c, m, default, key_type=types[c]) for c, m in small.items()}
    ) if small else df
    for c, m in mappings.items():
        if c not in small:
            out = map_codes_lookup(out, c, m, out=f"{c}{suffix}", default=default)
    return out


def map_codes_lookup(
    df: DataFrame,
    col: str,
    lookup: DataFrame | Mapping[object, str],
    out: str | None = None,
    default: str | None = "Unknown",
    key_col: str = "code",
    label_col: str = "label",
) -> DataFrame:
    """The same mapping as :func:`map_codes` as a left join with a lookup
    table, for code lists too large to inline. The lookup is broadcast only
    when its size is under the session bound; else a shuffle join (AQE splits
    a hot code on the big side). A code with several labels raises."""
    spark = df.sparkSession
    out = out or f"{col}_mapped"
    key_type = dict(df.dtypes)[col]
    if isinstance(lookup, Mapping):
        if not lookup:
            return df.withColumn(out, F.lit(default).cast("string"))
        # typed literals, as in the map form
        pairs = map_literal([(sql_literal(k, key_type), sql_literal(v, "STRING")) for k, v in lookup.items()])
        lk = spark.range(1).select(F.explode(F.expr(pairs)).alias("__code", "__label"))
        small = len(lookup) <= broadcast_row_limit(spark)
    else:
        lk = lookup.select(
            F.col(key_col).cast(key_type).alias("__code"), F.col(label_col).cast("string").alias("__label")
        ).distinct()
        several = lk.groupBy("__code").count().where("count > 1 and __code is not null").limit(5).collect()
        if several:
            raise AmbiguousCode(f"codes with several labels: {[r['__code'] for r in several]}")
        small = fits_broadcast(lk)
    if small:
        lk = F.broadcast(lk)
    joined = df.join(lk, df[col] == lk["__code"], "left")
    label = F.col("__label") if default is None else F.coalesce(F.col("__label"), F.lit(default))
    return joined.withColumn(out, label).drop("__code", "__label")


def id_suffix(
    df: DataFrame, col: str, out: str | None = None, start: int = 5, length: int = 10, to: str = "int"
) -> DataFrame:
    """``out = try_cast(substring(cast(col as string), start, length) as to)``."""
    return df.withColumn(out or f"{col}_int", id_suffix_expr(col, start, length, to))


def cast_columns(df: DataFrame, types: Mapping[str, str], suffix: str = "") -> DataFrame:
    """Cast many columns in one projection; a value that does not fit becomes
    NULL instead of failing the job. With ``suffix`` the originals are kept."""
    src = dict(df.dtypes)
    return df.withColumns({f"{c}{suffix}": safe_cast(c, t, src[c]) for c, t in types.items()})
