"""Readers: CSV (one file, a directory or a glob), parquet with partition
discovery, catalog tables, temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata_engine.functions.casts import safe_cast


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    sampling_ratio: float | None = None,
    **options,
) -> DataFrame:
    """CSV reader. With ``schema`` the types are declared (no extra pass);
    ``infer_schema`` costs one more scan (use ``sampling_ratio`` on big
    inputs). Without header and schema every column is a string ``_c0…``
    and a header line is read as data. A declared schema with a header is
    matched by position and the names are checked (a swapped header raises);
    ``read_csv_by_name`` matches by name."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
        if header:
            reader = reader.option("enforceSchema", "false")
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", str(sampling_ratio))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


# Default name of the column that lists the columns whose value did not parse.
BAD_VALUES = "_bad_values"


class HeaderMismatch(ValueError):
    pass


def read_csv_by_name(
    spark: SparkSession, path: str | list[str], schema: StructType, bad_values: str | None = None, **options
) -> DataFrame:
    """CSV with header lines into the columns of ``schema``, matched by name
    whatever their order; further columns of the file are not read.

    A column that the header lacks raises, and so does a file whose header
    differs from the others'. A value that does not parse becomes NULL; with
    ``bad_values`` an array column of that name lists the columns it happened
    in (empty for a clean row). One pass, no inference.
    """
    def reader():
        r = spark.read.option("header", "true")
        for k, v in options.items():
            r = r.option(k, v)
        return r

    header = reader().csv(path).columns  # reads the first line only
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise HeaderMismatch(f"the header lacks {missing}; it has {header}")
    text = StructType([StructField(c, StringType()) for c in header])
    # every file's header is held against these names and their order
    raw = reader().schema(text).option("enforceSchema", "false").csv(path)
    source = dict(raw.dtypes)
    parsed = {f.name: safe_cast(f.name, f.dataType.simpleString(), source[f.name]) for f in schema.fields}
    columns = [c.alias(name) for name, c in parsed.items()]
    if bad_values is not None:
        none = F.array().cast("array<string>")
        bad = [F.when(F.col(n).isNotNull() & c.isNull(), F.array(F.lit(n))).otherwise(none) for n, c in parsed.items()]
        columns.append(F.concat(*bad).alias(bad_values))
    return raw.select(*columns)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet reader; ``key=value`` directories become columns (placed after
    the file columns) and filters on them prune directories."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def register(df: DataFrame, name: str) -> DataFrame:
    """Temp view for ``spark.sql`` over a layer."""
    df.createOrReplaceTempView(name)
    return df
