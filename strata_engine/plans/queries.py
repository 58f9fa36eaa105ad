"""Registered queries over the driver's tables, each with an independent
DuckDB SQL oracle (same column names and types; doubles rounded to 6
places on both sides). Every query reads whole tables.

Queries that save and read back write to a fresh folder under the session's
``spark.checkpoint.dir`` (shared storage on a cluster).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from strata_engine.functions import rules as R
from strata_engine.functions.casts import id_suffix as id_suffix_expr
from strata_engine.functions.numeric import round_half_away
from strata_engine.operators import clean, profile, quality, report, scale, schema, split, strata, transform
from strata_engine.plans import layers as L
from strata_engine.plans import orders as OP
from strata_engine.plans.publish import source_identity
from strata_engine.session import materialize, scratch_path
from strata_engine.sources import readers, writers

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DEC = 6  # rounding of doubles in compared outputs


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_SCHEMA = StructType([
    StructField("p_partkey", LongType()),
    StructField("p_name", StringType()),
    StructField("p_brand", StringType()),
    StructField("p_type", StringType()),
    StructField("p_size", IntegerType()),
    StructField("p_retailprice", DoubleType()),
])
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDERS_COLS = OP.ORDER_COLS
SEL_PART = ", ".join(PART_COLS)
SEL_ORDERS = ", ".join(ORDERS_COLS)


# ---------------------------------------------------------------------------
# 2.1 sources and sinks
# ---------------------------------------------------------------------------

@query("csv_scan", f"SELECT {SEL_PART} FROM part")
def csv_scan(spark, sf):
    """Header + inferred types (as the original reader), then the declared
    types: an inferred int key is widened back to bigint."""
    path = scratch_path(spark, "csv_scan")
    writers.save_csv(table(spark, sf, "part"), path, header=True)
    back = readers.read_csv(spark, path, header=True, infer_schema=True)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PART_SCHEMA.fields])


@query("csv_glob_scan", f"SELECT {SEL_PART} FROM part")
def csv_glob_scan(spark, sf):
    """Several CSV files read as one frame through a ``*.csv`` glob, with a
    declared schema (no inference pass)."""
    path = scratch_path(spark, "csv_glob")
    writers.save_csv(table(spark, sf, "part"), path, header=True)
    return readers.read_csv(spark, f"{path}/*.csv", schema=PART_SCHEMA, header=True).select(*PART_COLS)


@query(
    "csv_by_name",
    "SELECT p_partkey, p_name, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS p_size, "
    "CASE WHEN p_size % 7 = 0 THEN 'p_size' ELSE '' END AS bad FROM part",
)
def csv_by_name(spark, sf):
    """A file with columns in another order and values that do not parse:
    matched by header name, and every bad value is reported."""
    path = scratch_path(spark, "csv_by_name")
    bad_size = F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    shuffled = table(spark, sf, "part").select(bad_size.alias("p_size"), "p_retailprice", "p_name", "p_brand", "p_partkey")
    writers.save_csv(shuffled, path, header=True)
    wanted = StructType([f for f in PART_SCHEMA.fields if f.name in ("p_partkey", "p_name", "p_size")])
    back = readers.read_csv_by_name(spark, path, wanted, bad_values="bad")
    return back.withColumn("bad", F.array_join("bad", ","))


@query(
    "csv_headerless_scan",
    "SELECT CAST(count(*) AS BIGINT) AS n_data_lines, true AS header_line_in_every_file FROM part",
)
def csv_headerless_scan(spark, sf):
    """No header option: every column is a string and each file's header line
    is read as a data row."""
    path = scratch_path(spark, "csv_noheader")
    writers.save_csv(table(spark, sf, "part"), path, header=True)
    raw = readers.read_csv(spark, path, header=False)
    is_header = F.col("_c0") == F.lit("p_partkey")
    per_file = raw.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count_if(is_header).alias("headers"), F.count_if(~is_header).alias("lines")
    )
    return per_file.agg(
        F.sum("lines").alias("n_data_lines"), F.bool_and(F.col("headers") == 1).alias("header_line_in_every_file")
    )


@query("partitioned_roundtrip", f"SELECT {SEL_ORDERS} FROM orders")
def partitioned_roundtrip(spark, sf):
    """Partitioned snappy parquet save, then partition discovery on read; the
    partition column comes back last, so select the declared order."""
    path = scratch_path(spark, "orders_by_status")
    writers.save_parquet(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    return readers.read_parquet(spark, path).select(*ORDERS_COLS)


@query(
    "repartition_write",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows, true AS one_writer "
    "FROM orders GROUP BY o_orderstatus, o_orderpriority",
)
def repartition_write(spark, sf):
    """``repartition(n, key)`` before a two-level partitioned save: all rows
    of a key go through one task, so each directory has one writer. (The
    default clustering is a REBALANCE instead, which splits a hot key.)"""
    path = scratch_path(spark, "orders_clustered")
    writers.save_parquet(
        table(spark, sf, "orders"), path, partition_by=["o_orderstatus", "o_orderpriority"],
        cluster_by=["o_orderstatus", "o_orderpriority"], num_partitions=16,
    )
    back = readers.read_parquet(spark, path)
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1)
    return back.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count_distinct(task) == 1).alias("one_writer")
    )


@query("compressed_write", "SELECT 'gz' AS codec, count(*) AS n_rows, sum(o_orderkey) AS key_sum FROM orders")
def compressed_write(spark, sf):
    """A codec other than the default, read off the written files."""
    path = scratch_path(spark, "orders_gzip")
    writers.save_parquet(table(spark, sf, "orders"), path, compression="gzip")
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"\.(\w+)\.parquet$", 1).alias("codec")
    return readers.read_parquet(spark, path).groupBy(codec).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum")
    )


@query("table_roundtrip", f"SELECT {SEL_ORDERS} FROM orders")
def table_roundtrip(spark, sf):
    """Partitioned overwrite ``saveAsTable`` (external, in the shared folder),
    read back through the catalog."""
    name = f"orders_rt_{uuid.uuid4().hex[:10]}"
    path = scratch_path(spark, name)
    writers.save_table(table(spark, sf, "orders"), name, partition_by=["o_orderstatus"], path=path)
    back = materialize(readers.read_table(spark, name).select(*ORDERS_COLS), name)
    writers.drop_tables(spark, [name])
    return back


@query(
    "flat_table_drop",
    "SELECT 'kept' AS name, true AS listed, count(*) AS n_rows FROM orders "
    "UNION ALL SELECT 'dropped', false, NULL",
)
def flat_table_drop(spark, sf):
    """Two unpartitioned tables saved, one dropped: what the catalog lists,
    and the rows of the one that is left."""
    tag = uuid.uuid4().hex[:10]
    orders = table(spark, sf, "orders")
    names = {n: f"orders_{n}_{tag}" for n in ("kept", "dropped")}
    for full in names.values():
        writers.save_table(orders, full, path=scratch_path(spark, full))
    writers.drop_tables(spark, [names["dropped"]])
    listed = {n: spark.catalog.tableExists(full) for n, full in names.items()}
    rows = readers.read_table(spark, names["kept"]).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = materialize(rows.select(F.lit("kept").alias("name"), "n_rows"), "kept_rows")
    writers.drop_tables(spark, [names["kept"]])
    return spark.createDataFrame(list(listed.items()), "name string, listed boolean").join(rows, "name", "left")


def _hash_sql(key: str = "o_orderkey", seed: int = 42) -> str:
    return (
        f"(('0x' || substr(md5(concat_ws('-', '{seed}', CAST({key} AS VARCHAR))), 1, 8))::BIGINT"
        " / 4294967296.0::DOUBLE)"
    )


HASH_SPLIT_CASE = (
    f"CASE WHEN {_hash_sql()} < 0.6::DOUBLE THEN 'train' "
    f"WHEN {_hash_sql()} < 0.8::DOUBLE THEN 'validation' ELSE 'test' END"
)


@query(
    "split_tables",
    f"SELECT * FROM (SELECT {SEL_ORDERS}, {HASH_SPLIT_CASE} AS split FROM orders) WHERE split = 'validation'",
)
def split_tables(spark, sf):
    """All splits in one table partitioned by ``split``; one split is read
    back by partition pruning."""
    path = scratch_path(spark, "orders_splits")
    split.save_splits(split.hash_split(table(spark, sf, "orders"), ["o_orderkey"]), path)
    return split.read_split(spark, path, "validation").select(*ORDERS_COLS, "split")


# ---------------------------------------------------------------------------
# 2.2 projection and cleaning
# ---------------------------------------------------------------------------

def _lineitem_nulls(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumns({"l_discount": F.nullif("l_discount", F.lit(0.0)), "l_tax": F.nullif("l_tax", F.lit(0.0))})


@query(
    "null_row_drop",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag, l_linestatus, l_shipdate "
    "FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL AND nullif(l_tax, 0) IS NOT NULL",
)
def null_row_drop(spark, sf):
    return clean.drop_null_rows(_lineitem_nulls(spark, sf)).select(*LINEITEM_COLS)


DEMO_CODES = {1: "One", 2: "Two", 3: "Three", -9: "No answer"}
CODE_EXPR_SQL = "CASE WHEN l_tax = 0 THEN -9 WHEN l_discount = 0 THEN NULL ELSE l_linenumber END"
CODE_MAP_SQL = (
    f"SELECT l_orderkey, l_linenumber, code, CASE code "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in DEMO_CODES.items())
    + f" ELSE 'Unknown' END AS code_mapped FROM (SELECT l_orderkey, l_linenumber, {CODE_EXPR_SQL} AS code FROM lineitem)"
)


def _coded_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr(CODE_EXPR_SQL).cast("int").alias("code"))


@query("code_map", CODE_MAP_SQL)
def code_map(spark, sf):
    """Code → label with a default for unknown codes and NULL; ``-9`` is an
    ordinary key. One native expression (no UDF)."""
    return transform.map_codes(_coded_lineitem(spark, sf), {"code": DEMO_CODES})


@query("code_map_broadcast", CODE_MAP_SQL)
def code_map_broadcast(spark, sf):
    """The same mapping as a left join with a lookup table (broadcast: its
    size is known on the driver)."""
    return transform.map_codes_lookup(_coded_lineitem(spark, sf), "code", DEMO_CODES, out="code_mapped")


@query(
    "id_suffix_cast",
    "SELECT o_orderkey, CAST(20210000000 + o_orderkey AS BIGINT) AS caseid, "
    "TRY_CAST(substr(CAST(20210000000 + o_orderkey AS VARCHAR), 5, 10) AS INTEGER) AS caseid_int, "
    "TRY_CAST(substr(CAST(o_orderkey AS VARCHAR), 5, 10) AS INTEGER) AS key_suffix_int, "
    "TRY_CAST(substr(CAST((20210000000 + o_orderkey) * 1000000 AS VARCHAR), 1, 12) AS INTEGER) AS overflow_int "
    "FROM orders",
)
def id_suffix_cast(spark, sf):
    """Drop the 4-digit year prefix of the identifier; an empty suffix or a
    suffix too large for int gives NULL instead of an error."""
    o = table(spark, sf, "orders").select("o_orderkey")
    o = o.withColumn("caseid", F.lit(OP.ID_BASE) + F.col("o_orderkey"))
    return transform.id_suffix(o, "caseid", "caseid_int").withColumns({
        "key_suffix_int": id_suffix_expr("o_orderkey"),
        "overflow_int": id_suffix_expr(F.col("caseid") * F.lit(1000000), start=1, length=12),
    })


@query(
    "cast_columns",
    "SELECT p_partkey, TRY_CAST(p_partkey AS INTEGER) AS p_partkey_cast, TRY_CAST(p_size AS FLOAT) AS p_size_cast, "
    "TRY_CAST(big_key AS INTEGER) AS big_key_cast FROM (SELECT *, p_partkey * 10000000 AS big_key FROM part)",
)
def cast_columns(spark, sf):
    """Many casts in one projection; the out-of-range ones become NULL."""
    p = table(spark, sf, "part").withColumn("big_key", F.col("p_partkey") * F.lit(10000000))
    out = transform.cast_columns(p, {"p_partkey": "int", "p_size": "float", "big_key": "int"}, suffix="_cast")
    return out.select("p_partkey", "p_partkey_cast", "p_size_cast", "big_key_cast")


@query(
    "strata_key",
    "SELECT o_orderkey, concat_ws('_', o_orderstatus, o_orderpriority) AS strata, "
    "concat_ws('_', o_orderstatus, nullif(o_orderpriority, '5-LOW')) AS strata_skip_null, "
    "concat_ws('_', o_orderstatus, coalesce(nullif(o_orderpriority, '5-LOW'), 'NA')) AS strata_null_token "
    "FROM orders",
)
def strata_key(spark, sf):
    """Stratum key; NULL parts are skipped, or replaced by a token."""
    o = table(spark, sf, "orders").withColumn("prio", F.nullif("o_orderpriority", F.lit("5-LOW")))
    o = strata.add_strata(o, ["o_orderstatus", "o_orderpriority"], "strata")
    o = strata.add_strata(o, ["o_orderstatus", "prio"], "strata_skip_null")
    o = strata.add_strata(o, ["o_orderstatus", "prio"], "strata_null_token", null_token="NA")
    return o.select("o_orderkey", "strata", "strata_skip_null", "strata_null_token")


# ---------------------------------------------------------------------------
# 2.3 quality rules
# ---------------------------------------------------------------------------

LINEITEM_RULES = {
    "positive_quantity": "l_quantity > 0",
    "discount_cap": "l_discount <= 0.08",
    "taxed": "l_tax > 0",
    "valid_returnflag": "l_returnflag IN ('A', 'N', 'R')",
    "whole_quantity": "try_cast(l_quantity AS INT) = l_quantity",
}
RULE_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag"]


def _passes_sql(rule: str) -> str:
    return f"coalesce(({rule}), false)"


@query(
    "expect_drop",
    f"SELECT {', '.join(RULE_COLS)} FROM lineitem WHERE " + " AND ".join(f"({r})" for r in LINEITEM_RULES.values()),
)
def expect_drop(spark, sf):
    """Rows failing any rule are dropped; the AND of the rules is one filter
    (pushed to the scan where the predicate allows)."""
    return quality.enforce(table(spark, sf, "lineitem"), LINEITEM_RULES, "drop").select(*RULE_COLS)


@query(
    "expect_warn",
    f"SELECT {', '.join(RULE_COLS)}, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT {_passes_sql(r)} THEN '{n}' END" for n, r in LINEITEM_RULES.items())
    + ") AS failed_rules, CAST("
    + " + ".join(f"CASE WHEN NOT {_passes_sql(r)} THEN 1 ELSE 0 END" for r in LINEITEM_RULES.values())
    + " AS INTEGER) AS n_failed FROM lineitem",
)
def expect_warn(spark, sf):
    """All rows kept; the names of the failed rules are recorded per row."""
    flagged = quality.flag(table(spark, sf, "lineitem"), LINEITEM_RULES)
    return flagged.select(
        *RULE_COLS,
        F.array_join("failed_rules", ",").alias("failed_rules"),
        F.size("failed_rules").cast("int").alias("n_failed"),
    )


@query(
    "expect_report",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS rule, "
        f"CAST(count(*) FILTER (WHERE {_passes_sql(r)}) AS BIGINT) AS n_passed, "
        f"CAST(count(*) FILTER (WHERE NOT {_passes_sql(r)}) AS BIGINT) AS n_failed, "
        f"CAST(count(*) AS BIGINT) AS n_total FROM lineitem"
        for i, (n, r) in enumerate(LINEITEM_RULES.items())
    ),
)
def expect_report(spark, sf):
    """Passed / failed counts per rule in one aggregate pass."""
    return quality.report(table(spark, sf, "lineitem"), LINEITEM_RULES)


SENTINEL_RULE = R.in_range_or("tax_s", 0.02, -9, name="tax_or_sentinel")


@query(
    "rule_range_or_sentinel",
    "SELECT l_orderkey, l_linenumber, tax_s, coalesce((tax_s >= 0.02 OR tax_s = -9), false) AS passed "
    "FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 THEN -9.0 ELSE l_tax END AS tax_s FROM lineitem)",
)
def rule_range_or_sentinel(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_tax") == 0, F.lit(-9.0)).otherwise(F.col("l_tax")).alias("tax_s"),
    )
    return quality.passes(li, SENTINEL_RULE).select(
        "l_orderkey", "l_linenumber", "tax_s", F.col("tax_or_sentinel").alias("passed")
    )


CAST_RULES = {
    **R.lossless_cast("l_quantity", "INT", name="qty_int"),
    **R.lossless_cast("l_extendedprice", "INT", name="price_int"),
    **R.lossless_cast("caseid", "INT", name="caseid_int"),
}


@query(
    "rule_lossless_cast",
    "SELECT l_orderkey, l_linenumber, "
    "coalesce(TRY_CAST(l_quantity AS INTEGER) = l_quantity, false) AS qty_int, "
    "coalesce(TRY_CAST(l_extendedprice AS INTEGER) = l_extendedprice, false) AS price_int, "
    "coalesce(TRY_CAST(caseid AS INTEGER) = caseid, false) AS caseid_int "
    "FROM (SELECT *, 20210000000 + l_orderkey AS caseid FROM lineitem)",
)
def rule_lossless_cast(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("caseid", F.lit(OP.ID_BASE) + F.col("l_orderkey"))
    return quality.passes(li, CAST_RULES).select("l_orderkey", "l_linenumber", *CAST_RULES)


BOUND_RULES = {**R.at_least(["p_size"], 10), **R.at_least(["p_retailprice"], 950)}


@query(
    "rule_lower_bound",
    "SELECT p_partkey, coalesce(p_size >= 10, false) AND coalesce(p_retailprice >= 950, false) AS passed FROM part",
)
def rule_lower_bound(spark, sf):
    passed = quality.passes(table(spark, sf, "part"), BOUND_RULES)
    every = F.lit(True)
    for name in BOUND_RULES:
        every = every & F.col(name)
    return passed.select("p_partkey", every.alias("passed"))


@query(
    "rule_not_null",
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) IS NOT NULL AS passed FROM lineitem",
)
def rule_not_null(spark, sf):
    rules = R.not_null(["l_discount"])
    passed = quality.passes(_lineitem_nulls(spark, sf), rules)
    return passed.select("l_orderkey", "l_linenumber", *[F.col(n).alias("passed") for n in rules])


@query(
    "rule_not_blank",
    "SELECT doc_id, coalesce(text IS NOT NULL AND text != '', false) AS passed, "
    "coalesce(t2 IS NOT NULL AND t2 != '', false) AS passed_stripped "
    "FROM (SELECT doc_id, text, regexp_replace(text, '[A-Za-z]', '', 'g') AS t2 FROM documents)",
)
def rule_not_blank(spark, sf):
    """Not NULL and not empty, over whole texts: the text itself, and the
    text with all ASCII letters removed (empty for letter-only texts)."""
    letters = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1)) + "".join(chr(c) for c in range(ord("a"), ord("z") + 1))
    d = table(spark, sf, "documents").select("doc_id", "text", F.translate("text", letters, "").alias("t2"))
    rules = {**R.not_blank("text", "passed"), **R.not_blank("t2", "passed_stripped")}
    return quality.passes(d, rules).select("doc_id", *rules)


# ---------------------------------------------------------------------------
# 2.4 schema checks and summaries
# ---------------------------------------------------------------------------

EVENTS_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                ("event_type", "string"), ("value", "double"), ("props", "string")]


@query(
    "schema_summary",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
        f"count(*) - count({n}) AS n_null FROM ev"
        for i, (n, t) in enumerate(EVENTS_TYPES)
    ).replace("FROM ev", "FROM (SELECT * REPLACE (CASE WHEN value > 400 THEN NULL ELSE value END AS value) FROM events)"),
)
def schema_summary(spark, sf):
    """Column types with row and NULL counts (large values made NULL first)."""
    events = table(spark, sf, "events")
    return schema.profile(events.withColumn("value", F.when(~(F.col("value") > 400), F.col("value"))))


EVENTS_EXPECTED = StructType([
    StructField("event_id", LongType()),
    StructField("user_id", IntegerType()),
    StructField("ts", TimestampNTZType()),
    StructField("event_type", StringType()),
    StructField("value", IntegerType()),
    StructField("country", StringType()),
])


def _contract_sql() -> str:
    rows = [
        (0, "event_id", "bigint", "bigint", "ok", "0"),
        (1, "user_id", "int", "bigint", "type_mismatch", "count(*) FILTER (WHERE user_id NOT BETWEEN -2147483648 AND 2147483647)"),
        (2, "ts", "timestamp_ntz", "timestamp_ntz", "order", "0"),
        (3, "event_type", "string", "string", "ok", "0"),
        (4, "value", "int", "double", "type_mismatch", "count(*) FILTER (WHERE trunc(value) <> value)"),
        (5, "country", "string", "", "missing", None),
        (5, "props", "", "string", "unexpected", "0"),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS column_name, '{want}' AS expected_type, '{have}' AS actual_type, "
        f"'{status}' AS status, count(*) AS n_rows, "
        + (f"count(*) - count({n})" if bad is not None else "CAST(NULL AS BIGINT)") + " AS n_null, "
        + (f"CAST({bad} AS BIGINT)" if bad is not None else "CAST(NULL AS BIGINT)") + " AS n_bad FROM events"
        for i, n, want, have, status, bad in rows
    )


@query("schema_diff", _contract_sql())
def schema_diff(spark, sf):
    """Declared against actual types, with the values that the declared type
    cannot hold."""
    return schema.contract_report(table(spark, sf, "events"), EVENTS_EXPECTED)


# ---------------------------------------------------------------------------
# 2.5 scaling and indexing
# ---------------------------------------------------------------------------

def _minmax_sql(col: str, src: str) -> str:
    return (
        f"CASE WHEN {col} IS NULL THEN NULL WHEN (SELECT max({col}) - min({col}) FROM {src}) = 0 THEN 0.5 "
        f"ELSE ({col} - (SELECT min({col}) FROM {src}))::DOUBLE / (SELECT max({col}) - min({col}) FROM {src}) END"
    )


def _z_sql(col: str, src: str) -> str:
    return (
        f"CASE WHEN {col} IS NULL THEN NULL WHEN coalesce((SELECT stddev_samp({col}) FROM {src}), 0) = 0 THEN 0.0 "
        f"ELSE ({col} - (SELECT avg({col}) FROM {src})) / (SELECT stddev_samp({col}) FROM {src}) END"
    )


@query("min_max_scale", f"SELECT p_partkey, p_size, round({_minmax_sql('p_size', 'part')}, 6) AS p_size_normalized FROM part")
def min_max_scale(spark, sf):
    return scale.min_max(table(spark, sf, "part"), ["p_size"], decimals=DEC).select(
        "p_partkey", "p_size", "p_size_normalized"
    )


@query(
    "z_score_scale",
    f"SELECT o_orderkey, o_totalprice, round({_z_sql('o_totalprice', 'orders')}, 6) AS o_totalprice_standardized FROM orders",
)
def z_score_scale(spark, sf):
    return scale.z_score(table(spark, sf, "orders"), ["o_totalprice"], decimals=DEC).select(
        "o_orderkey", "o_totalprice", "o_totalprice_standardized"
    )


@query(
    "chained_scale",
    "WITH n AS (SELECT o_orderkey, o_totalprice, "
    f"{_minmax_sql('o_totalprice', 'orders')} AS nv FROM orders) "
    f"SELECT o_orderkey, o_totalprice, round(nv, 6) AS o_totalprice_normalized, "
    f"round({_z_sql('nv', 'n')}, 6) AS o_totalprice_standardized FROM n",
)
def chained_scale(spark, sf):
    """z-score of the min-max output (the production chain), one fit pass."""
    return scale.min_max_z(table(spark, sf, "orders"), ["o_totalprice"], decimals=DEC).select(
        "o_orderkey", "o_totalprice", "o_totalprice_normalized", "o_totalprice_standardized"
    )


MULTI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "multi_column_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({_minmax_sql(c, 'lineitem')}, 6) AS {c}_normalized" for c in MULTI)
    + ", "
    + ", ".join(f"round({_z_sql(c, 'lineitem')}, 6) AS {c}_standardized" for c in MULTI)
    + " FROM lineitem",
)
def multi_column_scale(spark, sf):
    """Four columns, both scalings: every statistic in ONE aggregate job."""
    li = table(spark, sf, "lineitem")
    out = scale.scale(li, MULTI, ("min_max", "z_score"), decimals=DEC)
    return out.select(
        "l_orderkey", "l_linenumber", *[f"{c}_normalized" for c in MULTI], *[f"{c}_standardized" for c in MULTI]
    )


ORDERS_STRATA_SQL = "concat_ws('_', o_orderstatus, o_orderpriority)"


@query(
    "string_index",
    f"SELECT o_orderkey, s.strata, i.strata_index FROM (SELECT o_orderkey, {ORDERS_STRATA_SQL} AS strata FROM orders) s "
    "JOIN (SELECT strata, CAST(row_number() OVER (ORDER BY count(*) DESC, strata) - 1 AS DOUBLE) AS strata_index "
    f"FROM (SELECT {ORDERS_STRATA_SQL} AS strata FROM orders) GROUP BY strata) i ON s.strata = i.strata",
)
def string_index(spark, sf):
    """Most frequent stratum → 0.0; ties alphabetical."""
    o = strata.add_strata(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                          ["o_orderstatus", "o_orderpriority"], "strata")
    return strata.frequency_index(o, "strata", "strata_index").select("o_orderkey", "strata", "strata_index")


# ---------------------------------------------------------------------------
# 2.6 sampling and splits
# ---------------------------------------------------------------------------

@query("hash_split", f"SELECT o_orderkey, {HASH_SPLIT_CASE} AS split FROM orders")
def hash_split(spark, sf):
    return split.hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


STRATIFIED_SQL = (
    "SELECT o_orderkey, strata, CASE WHEN rn <= floor(0.6::DOUBLE * n + 0.5::DOUBLE) THEN 'train' "
    "WHEN rn <= floor(0.8::DOUBLE * n + 0.5::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ("
    f"SELECT o_orderkey, {ORDERS_STRATA_SQL} AS strata, "
    f"row_number() OVER (PARTITION BY {ORDERS_STRATA_SQL} ORDER BY md5(concat_ws('-', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS rn, "
    f"count(*) OVER (PARTITION BY {ORDERS_STRATA_SQL}) AS n FROM orders)"
)


def _stratified_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = strata.add_strata(o, ["o_orderstatus", "o_orderpriority"], "strata")
    return split.stratified_split(o, "strata", ["o_orderkey"])


@query("stratified_split", STRATIFIED_SQL)
def stratified_split(spark, sf):
    """Exact 60/20/20 within every stratum, by key hash order."""
    return _stratified_orders(spark, sf).select("o_orderkey", "strata", "split")


@query(
    "stratified_split_rounds",
    STRATIFIED_SQL.replace("o_orderkey", "l_key").replace(ORDERS_STRATA_SQL, "concat_ws('_', l_returnflag, l_linestatus)").replace(
        "FROM orders",
        "FROM (SELECT DISTINCT l_returnflag, l_linestatus, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS l_key FROM lineitem)",
    ),
)
def stratified_split_rounds(spark, sf):
    """The same split of ``lineitem`` with a bound so small that cuts are
    searched in several rounds."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    li = table(spark, sf, "lineitem").select(key.alias("l_key"), F.concat_ws("_", "l_returnflag", "l_linestatus").alias("strata"))
    li = li.distinct()
    return split.stratified_split(li, "strata", ["l_key"], target_rows=2).select("l_key", "strata", "split")


def _split_facts(arms: DataFrame, weights: dict[str, float]) -> DataFrame:
    """What holds for every random split: all rows once, no key in two arms,
    shares near the weights (within 5 standard deviations)."""
    keys = arms.groupBy("o_orderkey").agg(F.count_distinct("split").alias("arms"))
    over = keys.agg(F.count_if(F.col("arms") > 1).alias("overlap"), F.count(F.lit(1)).alias("n_keys"))
    total = arms.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("split") == n).alias(n) for n in weights])
    near = F.lit(True)
    for name, w in weights.items():
        near = near & (F.abs(F.col(name) - w * F.col("n_rows")) <= 5 * F.sqrt(F.col("n_rows") * w * (1 - w)))
    # one row each
    return total.join(F.broadcast(over), F.lit(True)).select("n_rows", "n_keys", "overlap", near.alias("shares_near"))


SPLIT_FACTS_SQL = (
    "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, CAST(0 AS BIGINT) AS overlap, true AS shares_near FROM orders"
)
ARMS = {"train": 0.6, "validation": 0.2, "test": 0.2}


@query("random_split", SPLIT_FACTS_SQL)
def random_split(spark, sf):
    """Seeded random 60/20/20 in one pass (``randomSplit`` semantics:
    repeatable for the same partition layout only)."""
    drawn = split.random_split_column(table(spark, sf, "orders").select("o_orderkey"), seed=42)
    return _split_facts(materialize(drawn, "random_split"), ARMS)


@query("nested_random_split", SPLIT_FACTS_SQL)
def nested_random_split(spark, sf):
    """``randomSplit`` 80/20, then the larger part 75/25."""
    parts = split.three_way(table(spark, sf, "orders").select("o_orderkey"), seed=42)
    arms = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    return _split_facts(materialize(arms[0].unionByName(arms[1]).unionByName(arms[2]), "nested_split"), ARMS)


@query(
    "split_report",
    "SELECT split, strata, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share_of_split, "
    "round(n / sum(n) OVER (PARTITION BY strata), 6) AS share_of_strata FROM ("
    f"SELECT split, strata, count(*) AS n FROM ({STRATIFIED_SQL}) GROUP BY split, strata)",
)
def split_report(spark, sf):
    return report.split_report(_stratified_orders(spark, sf), "split", "strata", decimals=DEC)


# ---------------------------------------------------------------------------
# 2.7 profiles and reports
# ---------------------------------------------------------------------------

def _summary_sql(cols: list[str], src: str, with_count: bool) -> str:
    parts = []
    for i, c in enumerate(cols):
        cnt = f"count({c}) AS count, " if with_count else ""
        if with_count:
            body = (f"{cnt}round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS stddev, "
                    f"round(min({c}::DOUBLE), 6) AS min, round(max({c}::DOUBLE), 6) AS max")
        else:
            body = (f"round(min({c}::DOUBLE), 6) AS min, round(max({c}::DOUBLE), 6) AS max, "
                    f"round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS stddev")
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, {body} FROM {src}")
    return " UNION ALL ".join(parts)


@query("column_summary", _summary_sql(["p_size", "p_retailprice"], "part", False))
def column_summary(spark, sf):
    return profile.summarize(table(spark, sf, "part"), ["p_size", "p_retailprice"], decimals=DEC)


@query(
    "exact_extremes",
    "SELECT CAST(0 AS INTEGER) AS position, 'big' AS column_name, CAST(min(big) AS VARCHAR) AS min_exact, "
    "CAST(max(big) AS VARCHAR) AS max_exact FROM (SELECT 9007199254740992 + l_orderkey AS big FROM lineitem)",
)
def exact_extremes(spark, sf):
    """Extremes of integers that no double can tell apart."""
    li = table(spark, sf, "lineitem").select((F.lit(9007199254740992) + F.col("l_orderkey")).alias("big"))
    return profile.summarize(li, ["big"], exact=True).select("position", "column_name", "min_exact", "max_exact")


@query("describe_profile", _summary_sql(MULTI, "lineitem", True))
def describe_profile(spark, sf):
    return profile.describe(table(spark, sf, "lineitem"), MULTI, decimals=DEC)


TEXT_COLS = ["p_name", "p_brand", "p_type"]


@query(
    "describe_text",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, count({c}) AS count, "
        f"min({c}) AS min, max({c}) AS max FROM part"
        for i, c in enumerate(TEXT_COLS)
    ),
)
def describe_text(spark, sf):
    """``describe()`` of the string columns: count, min, max."""
    return profile.describe_text(table(spark, sf, "part"), TEXT_COLS)


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf):
    return profile.row_count(table(spark, sf, "lineitem"))


@query("ordered_preview", f"SELECT {SEL_ORDERS} FROM orders ORDER BY o_orderkey LIMIT 10")
def ordered_preview(spark, sf):
    return profile.preview(table(spark, sf, "orders"), ["o_orderkey"], 10).select(*ORDERS_COLS)


PRIO_CASE_SQL = (
    "CASE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in OP.PRIORITY_LABELS.items())
    + " ELSE 'Unknown' END"
)


@query(
    "group_summary",
    "SELECT o_orderstatus, prio_mapped, count(*) AS n_rows, round(avg(o_totalprice), 6) AS avg_o_totalprice, "
    "min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice FROM ("
    f"SELECT *, {PRIO_CASE_SQL} AS prio_mapped FROM orders) GROUP BY o_orderstatus, prio_mapped",
)
def group_summary(spark, sf):
    """Aggregates per mapped label (silver-layer summary)."""
    o = table(spark, sf, "orders").withColumn("prio_code", F.substring("o_orderpriority", 1, 1).try_cast("int"))
    o = transform.map_codes(o, {"prio_code": OP.PRIORITY_LABELS}).withColumnRenamed("prio_code_mapped", "prio_mapped")
    return profile.group_summary(o, ["o_orderstatus", "prio_mapped"], ["o_totalprice"], decimals=DEC)


# ---------------------------------------------------------------------------
# 2.8 layers (the orders plan), run log, pipeline report, SQL over layers
# ---------------------------------------------------------------------------

_RUNS: dict[tuple[str, str, str], dict[str, L.LayerResult]] = {}
_RUNS_LOCK = threading.Lock()


def pipeline(spark: SparkSession, sf: str, fresh: bool = False) -> dict[str, L.LayerResult]:
    """Run the orders plan once per session, input path and state of its
    files, and reuse its saved layers across queries; ``fresh`` forces a new
    run."""
    orders = table(spark, sf, "orders")
    key = (spark.sparkContext.applicationId, sf, source_identity(orders))
    with _RUNS_LOCK:
        if fresh or key not in _RUNS:
            root = scratch_path(spark, "orders_layers")
            _RUNS[key] = OP.run(spark, orders, root)
        return _RUNS[key]


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: round_half_away(c, DEC) for c in cols if c in df.columns})


def _layer_sql(name: str, cols: list[str]) -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in OP.SCALED else c for c in cols)
    return OP.oracle_chain(name) + f"SELECT {sel} FROM {name}"


def _layer_query(name: str, cols: list[str]):
    def fn(spark, sf):
        return _rounded(pipeline(spark, sf)[name].frame, OP.SCALED).select(*cols)
    fn.__name__ = f"layer_{name}"
    return fn


for _qname, _layer, _cols in [
    ("layer_bronze", "bronze", OP.BRONZE_COLS),
    ("layer_silver_typed", "silver_typed", OP.TYPED_COLS),
    ("layer_silver_scaled", "silver_scaled", OP.SCALED_COLS),
    ("layer_silver_split", "silver_split", OP.SPLIT_COLS),
    ("layer_gold_full", "gold_full", OP.GOLD_COLS),
    ("layer_gold_splits", "gold_splits", OP.GOLD_SPLIT_COLS),
]:
    query(_qname, _layer_sql(_layer, _cols))(_layer_query(_layer, _cols))


def _run_log_sql() -> str:
    parts = []
    for name in OP.LAYER_NAMES:
        parts.append(f"SELECT '{name}' AS layer, 'rows_in' AS metric, CAST(count(*) AS BIGINT) AS value FROM {name}__built")
        if name in OP.NULLS_DROPPED_FROM:
            source = OP.NULLS_DROPPED_FROM[name]
            parts.append(f"SELECT '{name}', 'rows_read', CAST(count(*) AS BIGINT) FROM {source}")
            parts.append(
                f"SELECT '{name}', 'null_rows', CAST((SELECT count(*) FROM {source}) - count(*) AS BIGINT) FROM {name}__built"
            )
        parts.append(f"SELECT '{name}', 'rows_out', CAST(count(*) AS BIGINT) FROM {name}")
        for rn, rule in OP.ORACLE_RULES[name].items():
            parts.append(
                f"SELECT '{name}', 'failed:{rn}', CAST(count(*) FILTER (WHERE NOT coalesce(({rule}), false)) AS BIGINT) "
                f"FROM {name}__built"
            )
    return OP.oracle_chain(OP.LAYER_NAMES[-1]) + " UNION ALL ".join(parts)


@query("layer_run_log", _run_log_sql())
def layer_run_log(spark, sf):
    """Rows in / out and failures per rule for every layer, gathered by
    ``observe`` during the saves (no extra pass)."""
    return L.run_log(spark, pipeline(spark, sf))


REPORT_TYPES = OP.TYPES
LAYER_COLS = {
    "bronze": OP.BRONZE_COLS, "silver_typed": OP.TYPED_COLS, "silver_scaled": OP.SCALED_COLS,
    "silver_split": OP.SPLIT_COLS, "gold_full": OP.GOLD_COLS, "gold_splits": OP.GOLD_SPLIT_COLS,
}


def _report_sql() -> str:
    types = ", ".join(
        f"('{layer}', '{c}', 'type', '{REPORT_TYPES[c]}', CAST(NULL AS DOUBLE))"
        for layer, cols in LAYER_COLS.items() for c in cols
    )
    stats = " UNION ALL ".join(
        f"SELECT 'silver_scaled', '{c}', '{stat}', CAST(NULL AS VARCHAR), round({fn}({c}), 6) FROM silver_scaled"
        for c in OP.SCALED
        for stat, fn in (("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_samp"))
    )
    return (
        OP.oracle_chain("silver_scaled")
        + f"SELECT * FROM (VALUES {types}) AS t(layer, column_name, item, data_type, num_value) UNION ALL {stats}"
    )


@query("pipeline_report", _report_sql())
def pipeline_report(spark, sf):
    """Column types of every layer plus the scaled columns' summary."""
    return L.pipeline_report(pipeline(spark, sf), {"silver_scaled": OP.SCALED}, decimals=DEC)


@query(
    "sql_over_layers",
    OP.oracle_chain("gold_splits")
    + "SELECT split, prio_mapped, count(*) AS n_rows, round(avg(o_totalprice), 6) AS avg_price, "
    "round(avg(o_totalprice_standardized), 6) AS avg_z FROM gold_splits GROUP BY split, prio_mapped",
)
def sql_over_layers(spark, sf):
    """Saved layers registered as views and queried with Spark SQL."""
    runs = pipeline(spark, sf)
    for name, res in runs.items():
        readers.register(res.frame, f"layer_{name}")
    return spark.sql(
        "SELECT split, prio_mapped, count(*) AS n_rows, round(avg(o_totalprice), 6) AS avg_price, "
        "round(avg(o_totalprice_standardized), 6) AS avg_z FROM layer_gold_splits GROUP BY split, prio_mapped"
    )


# ---------------------------------------------------------------------------
# 2.10 proportions against a codebook
# ---------------------------------------------------------------------------

SEGMENT_EXPECTED = {s: 0.2 for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}


@query(
    "category_proportions",
    "SELECT c_mktsegment AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 6) AS share "
    "FROM customer GROUP BY c_mktsegment",
)
def category_proportions(spark, sf):
    p = quality.proportions(table(spark, sf, "customer"), "c_mktsegment")
    return p.withColumn("share", round_half_away("share", DEC))


@query(
    "proportion_drift",
    "SELECT coalesce(o.value, e.value) AS value, CAST(coalesce(o.n, 0) AS BIGINT) AS n, "
    "round(coalesce(o.share, 0.0), 6) AS share, e.expected_share, "
    "round(abs(coalesce(o.share, 0.0) - coalesce(e.expected_share, 0.0)), 6) AS abs_diff, "
    "abs(coalesce(o.share, 0.0) - coalesce(e.expected_share, 0.0)) <= 0.01 AS within_tolerance FROM "
    "(SELECT c_mktsegment AS value, count(*) AS n, count(*) / (SELECT count(*) FROM customer)::DOUBLE AS share "
    "FROM customer GROUP BY c_mktsegment) o FULL OUTER JOIN (VALUES "
    + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in SEGMENT_EXPECTED.items())
    + ") AS e(value, expected_share) ON o.value = e.value",
)
def proportion_drift(spark, sf):
    p = quality.proportions(table(spark, sf, "customer"), "c_mktsegment", SEGMENT_EXPECTED, tolerance=0.01)
    return p.withColumns({"share": round_half_away("share", DEC), "abs_diff": round_half_away("abs_diff", DEC)})


# further queries register themselves in the tables above
from strata_engine.plans import queries_layers, queries_stats, queries_survey  # noqa: E402, F401
