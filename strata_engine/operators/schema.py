"""Schema contracts and summaries. Contracts read only ``df.schema``;
``profile`` and ``contract_report`` also count, per column, the NULLs and the
values that the declared type cannot hold (one aggregate)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

MODES = ("names", "names_types", "exact")


class SchemaMismatch(AssertionError):
    pass


def _fields(schema: StructType, mode: str) -> list[tuple]:
    if mode == "names":
        return [(f.name,) for f in schema.fields]
    if mode == "names_types":
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if mode == "exact":
        return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
    raise ValueError(f"mode must be one of {MODES}")


def matches(df: DataFrame | StructType, expected: StructType, mode: str = "names_types") -> bool:
    """Same fields in the same order; ``names_types`` (default) ignores
    nullability and metadata, which native expressions set differently from
    hand-written declarations; ``exact`` compares those too."""
    actual = df.schema if isinstance(df, DataFrame) else df
    return _fields(actual, mode) == _fields(expected, mode)


def check(df: DataFrame, expected: StructType, mode: str = "names_types") -> DataFrame:
    """Raise :class:`SchemaMismatch` listing the differences; return ``df``."""
    if not matches(df, expected, mode):
        problems = [r for r in diff_rows(df.schema, expected) if r[4] != "ok"]
        raise SchemaMismatch(f"schema differs ({mode}): {problems}")
    return df


def diff_rows(actual: StructType, expected: StructType) -> list[tuple]:
    """(position, column_name, expected_type, actual_type, status) per field
    of either schema; status: ok, type_mismatch, nullability, order, missing,
    unexpected."""
    act = {f.name: (i, f) for i, f in enumerate(actual.fields)}
    rows = []
    for i, f in enumerate(expected.fields):
        if f.name not in act:
            rows.append((i, f.name, f.dataType.simpleString(), None, "missing"))
            continue
        j, a = act[f.name]
        if a.dataType != f.dataType:
            status = "type_mismatch"
        elif j != i:
            status = "order"
        elif a.nullable != f.nullable:
            status = "nullability"
        else:
            status = "ok"
        rows.append((i, f.name, f.dataType.simpleString(), a.dataType.simpleString(), status))
    names = {f.name for f in expected.fields}
    for j, a in enumerate(actual.fields):
        if a.name not in names:
            rows.append((j, a.name, None, a.dataType.simpleString(), "unexpected"))
    return rows


DIFF_SCHEMA = StructType([
    StructField("position", IntegerType()),
    StructField("column_name", StringType()),
    StructField("expected_type", StringType()),
    StructField("actual_type", StringType()),
    StructField("status", StringType()),
])

SUMMARY_SCHEMA = StructType([
    StructField("position", IntegerType()),
    StructField("column_name", StringType()),
    StructField("data_type", StringType()),
    StructField("nullable", BooleanType()),
])


def diff(df: DataFrame, expected: StructType) -> DataFrame:
    return df.sparkSession.createDataFrame(diff_rows(df.schema, expected), DIFF_SCHEMA)


def summary_rows(schema: StructType) -> list[tuple]:
    return [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]


def summary(df: DataFrame) -> DataFrame:
    """Column → type table (the reference's type-conversion summary)."""
    return df.sparkSession.createDataFrame(summary_rows(df.schema), SUMMARY_SCHEMA)


def _per_column(df: DataFrame, rows: list[tuple], names: list[str], counts: dict[str, dict]) -> DataFrame:
    """``rows`` (driver-side, one per field; column name second) with the
    counts of one aggregate over ``df`` beside them."""
    aggs = [c.alias(f"{kind}:{col}") for col, kinds in counts.items() for kind, c in kinds.items()]
    kinds = list(next(iter(counts.values()), {}))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    columns = []
    for r in rows:
        values = [F.lit(v).alias(n) for v, n in zip(r, names)]
        found = [F.col(f"`{k}:{r[1]}`") if r[1] in counts else F.lit(None).cast("bigint") for k in kinds]
        columns.append(F.struct(*values, F.col("rows").alias("n_rows"), *[c.alias(k) for c, k in zip(found, kinds)]))
    return wide.select(F.inline(F.array(*columns)))


def profile(df: DataFrame) -> DataFrame:
    """Column → type table with counts of the data: position, column_name, data_type, n_rows, n_null."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    counts = {f.name: {"n_null": F.count_if(F.col(f"`{f.name}`").isNull())} for f in df.schema.fields}
    return _per_column(df, rows, ["position", "column_name", "data_type"], counts)


def contract_report(df: DataFrame, expected: StructType) -> DataFrame:
    """``diff_rows`` with the data's counts: n_rows, n_null and n_bad (values
    that become NULL, or another value, in the expected type)."""
    actual = dict(df.dtypes)
    counts = {}
    rows = [tuple("" if v is None else v for v in r) for r in diff_rows(df.schema, expected)]
    for _, name, want, have, _ in rows:
        if name not in actual:
            continue
        c = F.col(f"`{name}`")
        bad = F.lit(0).cast("bigint")
        if want and want != have:
            back = c.try_cast(want)
            bad = F.count_if(c.isNotNull() & (back.isNull() | (back.cast(have) != c)))
        counts[name] = {"n_null": F.count_if(c.isNull()), "n_bad": bad if want and want != have else F.sum(bad)}
    return _per_column(df, rows, ["position", "column_name", "expected_type", "actual_type", "status"], counts)
