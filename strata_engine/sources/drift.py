"""CSV files of differing layouts below one glob: what differs, and reading
them as one table all the same.

Every file's own header says where its columns are. Headers are taken by one
aggregate (the first line of each file), rows are read once as text cells and
meet the header of their file; nothing is opened file by file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata_engine.functions.casts import safe_cast
from strata_engine.session import fits_broadcast, materialize

FILE, HEADER, CELLS = "file", "strata_header", "strata_cells"


def file_headers(spark: SparkSession, path: str | list[str], sep: str = ",", **options) -> DataFrame:
    """One row per file: file, strata_header (its column names in order). A
    file without any line has no row. ``options`` are the CSV reader's."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"),
    )
    # a file's first line is the first of its first block; ids grow along a block
    first = materialize(lines.where("at = 0").groupBy(FILE).agg(F.min_by("line", "id").alias("line")), "header_lines")
    most = first.agg(F.max(F.size(F.split("line", re.escape(sep))))).first()[0] or 1
    names = [f"_c{i}" for i in range(most)]
    cells = F.from_csv("line", ", ".join(f"{n} string" for n in names), {**options, "sep": sep})
    listed = first.select(FILE, cells.alias("cells")).select(FILE, F.array(*[F.col(f"cells.{n}") for n in names]).alias("cells"))
    # a line's cells end at its last name
    last = F.array_max(F.transform("cells", lambda c, i: F.when(c.isNotNull(), i + 1)))
    return listed.select(FILE, F.slice("cells", 1, F.coalesce(last, F.lit(0))).alias(HEADER))


def _rows(spark: SparkSession, path: str | list[str], headers: DataFrame, sep: str, options: dict) -> DataFrame:
    """Every data line: file, strata_cells (its cells as text), strata_header.
    Lines equal to their file's header are header lines."""
    widest = headers.agg(F.max(F.size(HEADER))).first()[0] or 1
    text = StructType([StructField(f"_c{i}", StringType()) for i in range(widest)])
    raw = spark.read.schema(text).option("sep", sep).option("header", "false")
    for k, v in options.items():
        raw = raw.option(k, v)
    cells = F.array(*[F.col(f"_c{i}") for i in range(widest)])
    rows = raw.csv(path).select(F.col("_metadata.file_path").alias(FILE), cells.alias(CELLS))
    # one row per file: small unless files are tiny
    headers = F.broadcast(headers) if fits_broadcast(headers) else headers
    joined = rows.join(headers, FILE)
    return joined.where(~F.slice(F.col(CELLS), 1, F.size(HEADER)).eqNullSafe(F.col(HEADER)))


def _value(name: str) -> Column:
    """The text of a column by its file's header; NULL if the file lacks it."""
    at = F.array_position(HEADER, name)
    return F.when(at > 0, F.get(CELLS, (at - 1).cast("int")))


def file_drift(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", **options
) -> DataFrame:
    """How each file below ``path`` departs from ``schema``: one row per file
    and column of either, with status

    * ``ok``: where it is declared to be; ``moved``: elsewhere in the file;
    * ``missing``: the file lacks it; ``extra``: it is not declared;

    position and expected_position (from 1; NULL if absent), n_rows (data
    lines of the file) and n_unparsed (values that its declared type cannot
    hold; 0 for extra columns). One aggregate over the data. A name that a
    header has twice counts at its first place."""
    headers = file_headers(spark, path, sep, **options)
    names = schema.fieldNames()
    bad = [F.count_if(_value(f.name).isNotNull() & safe_cast(_value(f.name), f.dataType.simpleString(), "string").isNull()) for f in schema.fields]
    counts = _rows(spark, path, headers, sep, options).groupBy(F.col(FILE).alias("counted")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*bad)).alias("bad")
    )
    declared = F.array(*map(F.lit, names))
    told = headers.join(counts, F.col(FILE) == F.col("counted"), "left")
    told = told.select(FILE, HEADER, "n_rows", "bad", F.explode(F.array_distinct(F.concat(declared, F.col(HEADER)))).alias("column_name"))
    place = F.nullif(F.array_position(HEADER, F.col("column_name")).cast("int"), F.lit(0))
    expected = F.nullif(F.array_position(declared, F.col("column_name")).cast("int"), F.lit(0))
    told = told.withColumns({"position": place, "expected_position": expected})
    status = F.when(F.col("position").isNull(), "missing").when(F.col("expected_position").isNull(), "extra")
    status = status.when(F.col("position") == F.col("expected_position"), "ok").otherwise("moved")
    zero = F.lit(0).cast("bigint")
    return told.select(
        FILE, "column_name", status.alias("status"), "position", "expected_position",
        F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce(F.element_at("bad", F.col("column_name")), zero).alias("n_unparsed"),
    )


def read_csv_drifted(
    spark: SparkSession, path: str | list[str], schema: StructType, bad_values: str | None = None, sep: str = ",", **options
) -> DataFrame:
    """The files below ``path`` as one table of ``schema``, each matched by
    its own header: a column that a file lacks is NULL there, further columns
    are not read, order does not matter. A value that does not parse becomes
    NULL; with ``bad_values`` an array column of that name lists the columns
    it happened in."""
    rows = _rows(spark, path, file_headers(spark, path, sep, **options), sep, options)
    parsed = {f.name: safe_cast(_value(f.name), f.dataType.simpleString(), "string") for f in schema.fields}
    columns = [c.alias(n) for n, c in parsed.items()]
    if bad_values is not None:
        none = F.array().cast("array<string>")
        bad = [F.when(_value(n).isNotNull() & c.isNull(), F.array(F.lit(n))).otherwise(none) for n, c in parsed.items()]
        columns.append(F.concat(*bad).alias(bad_values))
    return rows.select(*columns)
