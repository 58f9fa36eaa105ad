"""Queries on publishing layers: versions, resume, replaced partitions, and
the write that keeps and quarantines rows in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata_engine.operators import strata, verdicts
from strata_engine.plans import orders as OP
from strata_engine.plans import publish
from strata_engine.plans.layers import Layer
from strata_engine.plans.queries import LINEITEM_COLS, ORDERS_COLS, PART_SCHEMA, query, table
from strata_engine.session import scratch_path
from strata_engine.sources import drift, readers, writers

# ---------------------------------------------------------------------------
# 2.3 one write, two sinks
# ---------------------------------------------------------------------------

SINK_RULES = {
    "some_discount": "l_discount > 0.02",
    "taxed_or_returned": "l_tax > 0 OR l_returnflag = 'R'",
    "small": "nullif(l_quantity, 50) <= 40",
}


def _failed_sql(rules: dict[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN coalesce(({r}), false) THEN NULL ELSE '{n}' END" for n, r in rules.items())
    return f"concat_ws(',', {parts})"


@query(
    "two_sink_write",
    f"SELECT {', '.join(LINEITEM_COLS)}, {_failed_sql(SINK_RULES)} AS failed, "
    f"CASE WHEN {_failed_sql(SINK_RULES)} = '' THEN 'kept' ELSE 'quarantined' END AS sink, "
    f"(SELECT count(*) FROM lineitem WHERE {_failed_sql(SINK_RULES)} = '') AS n_kept FROM lineitem",
)
def two_sink_write(spark, sf):
    """Rules evaluated once; kept and quarantined rows leave in one write and
    are read back apart, the latter with the rules they fail. ``n_kept`` is
    what the write itself counted."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "two_sinks")
    counts = verdicts.save_verdicts(li, SINK_RULES, path, partition_by=["l_returnflag"])
    kept = verdicts.read_kept(spark, path, li.schema).withColumns({"failed": F.lit(""), "sink": F.lit("kept")})
    away = verdicts.read_quarantined(spark, path, li.schema)
    away = away.withColumns({"failed": F.array_join("failed_rules", ","), "sink": F.lit("quarantined")})
    both = kept.unionByName(away.drop("failed_rules"))
    return both.select(*LINEITEM_COLS, "failed", "sink", F.lit(counts["kept"]).cast("bigint").alias("n_kept"))


# ---------------------------------------------------------------------------
# 2.1 / 2.8 versioned publish
# ---------------------------------------------------------------------------

PRICE_RULES = {"price_floor": "o_totalprice >= 20000", "odd_customer": "o_custkey % 7 <> 0"}
_PRICED = "CASE WHEN o_orderstatus = 'F' AND version = 2 THEN 2 * o_totalprice ELSE o_totalprice END"
_PRICED_COLS = ", ".join(f"{_PRICED} AS o_totalprice" if c == "o_totalprice" else c for c in ORDERS_COLS)


def _all_versions(spark, root, name, numbers):
    """Rows of several versions, kept and quarantined ones."""
    parts = []
    for n in numbers:
        kept = publish.read(spark, root, name, n).withColumn("failed", F.lit(""))
        away = publish.read(spark, root, name, n, quarantined=True)
        away = away.withColumn("failed", F.array_join("failed_rules", ",")).drop("failed_rules")
        parts += [x.withColumn("version", F.lit(n)) for x in (kept, away)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query(
    "layer_publish",
    f"SELECT version, {', '.join(ORDERS_COLS)}, {_failed_sql(PRICE_RULES)} AS failed FROM "
    f"(SELECT version, {_PRICED_COLS} FROM orders, (VALUES (1), (2)) v(version))",
)
def layer_publish(spark, sf):
    """A layer published as version 1; then the rows of one status come in
    with other prices and replace that partition alone in version 2. Both
    versions, with their quarantined rows, as readers see them."""
    root = scratch_path(spark, "published")
    orders = table(spark, sf, "orders")
    layer = Layer("priced", lambda inputs: inputs["orders"], PRICE_RULES, partition_by=["o_orderstatus"], quarantine=True)
    publish.publish(spark, layer, {"orders": orders}, root)
    changed = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", 2 * F.col("o_totalprice"))
    publish.publish(spark, layer, {"orders": changed}, root, partitions_only=True)
    return _all_versions(spark, root, "priced", (1, 2)).select("version", *ORDERS_COLS, "failed")


class _Killed(RuntimeError):
    pass


def _kill(inputs):
    raise _Killed("the run ends here")


_RESUME_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS layer, {i < 3} AS resumed_after_kill, true AS resumed_when_unchanged, 1 AS version, "
    f"CAST(count(*) AS BIGINT) AS rows_out FROM {n}"
    for i, n in enumerate(OP.LAYER_NAMES)
)


@query("layer_resume", OP.oracle_chain(OP.LAYER_NAMES[-1]) + _RESUME_SQL)
def layer_resume(spark, sf):
    """The orders plan as versions: a first run ends in its fourth layer, a
    second goes on after the third, a third finds nothing to do. Row counts
    are of the published tables."""
    root = scratch_path(spark, "resumed")
    sources = {"orders": table(spark, sf, "orders")}
    layers = OP.layers()
    broken = [*layers[:3], Layer(layers[3].name, _kill)]
    try:
        publish.run_published(spark, broken, root, sources)
    except _Killed:
        pass
    second = publish.run_published(spark, layers, root, sources)
    third = publish.run_published(spark, layers, root, sources)
    rows = [(n, r.resumed, third[n].resumed, r.version) for n, r in second.items()]
    told = spark.createDataFrame(rows, "layer string, resumed_after_kill boolean, resumed_when_unchanged boolean, version int")
    counts = None
    for n in second:
        one = publish.read(spark, root, n).agg(F.count(F.lit(1)).alias("rows_out")).select(F.lit(n).alias("layer"), "rows_out")
        counts = one if counts is None else counts.unionByName(one)
    return told.join(counts, "layer")


# ---------------------------------------------------------------------------
# 2.1 clustered save with measured salts; files of differing layouts
# ---------------------------------------------------------------------------

ROWS_PER_FILE = 2000
_SKEWED = "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE concat('k', l_suppkey % 25) END"


@query(
    "salted_write",
    f"SELECT {_SKEWED} AS k, count(*) AS n_rows, sum(l_orderkey)::BIGINT AS key_sum, true AS bounded_files, true AS few_files, "
    f"true AS small_keys_whole FROM lineitem GROUP BY k",
)
def salted_write(spark, sf):
    """A third of all rows under one key, written by as many tasks as the key
    needs files; keys that fit into a file stay in one."""
    li = table(spark, sf, "lineitem").withColumn("k", F.expr(_SKEWED))
    path = scratch_path(spark, "salted")
    writers.save_salted(li, path, ["k"], ROWS_PER_FILE)
    files = readers.read_parquet(spark, path).groupBy("k", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum")
    )
    n, needed = F.sum("n"), F.ceil(F.sum("n") / (writers.FILL * ROWS_PER_FILE))
    return files.groupBy("k").agg(
        n.alias("n_rows"),
        F.sum("key_sum").alias("key_sum"),
        (F.max("n") <= ROWS_PER_FILE).alias("bounded_files"),
        (F.count(F.lit(1)) <= 2 * needed).alias("few_files"),
        ((n > ROWS_PER_FILE) | (F.count(F.lit(1)) == 1)).alias("small_keys_whole"),
    )


def _drifted_files(spark, sf):
    """`part` as CSV files of three layouts: as declared; columns in another
    order with sizes that are no numbers; one column less and one more."""
    part, root = table(spark, sf, "part"), scratch_path(spark, "drift")
    names = PART_SCHEMA.fieldNames()
    writers.save_csv(part.where("p_partkey % 3 = 0").select(*names), f"{root}/a")
    odd = F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("p_size")
    writers.save_csv(part.where("p_partkey % 3 = 1").select(odd, *[n for n in reversed(names) if n != "p_size"]), f"{root}/b")
    more = [n for n in names if n != "p_brand"]
    writers.save_csv(part.where("p_partkey % 3 = 2").select(*more, F.lit("new, and quoted").alias("note, more")), f"{root}/c")
    return f"{root}/*/*.csv"


_MOVED_B = {"p_size": 1, "p_retailprice": 2, "p_type": 3, "p_brand": 4, "p_name": 5, "p_partkey": 6}
_PLACES = [(n, i) for i, n in enumerate(PART_SCHEMA.fieldNames(), 1)]
_DRIFT_SQL = " UNION ALL ".join(
    [f"SELECT 'a' AS layout, '{n}' AS column_name, 'ok' AS status, {i} AS position, {i} AS expected_position, "
     "count(*) FILTER (p_partkey % 3 = 0) AS n_rows, 0::BIGINT AS n_unparsed FROM part" for n, i in _PLACES]
    + [f"SELECT 'b', '{n}', '{'ok' if _MOVED_B[n] == i else 'moved'}', {_MOVED_B[n]}, {i}, count(*) FILTER (p_partkey % 3 = 1), "
       + ("count(*) FILTER (p_partkey % 3 = 1 AND p_size % 7 = 0)" if n == "p_size" else "0::BIGINT") + " FROM part" for n, i in _PLACES]
    + [f"SELECT 'c', '{n}', '{'missing' if n == 'p_brand' else 'ok' if i < 3 else 'moved'}', "
       f"{'NULL' if n == 'p_brand' else i if i < 3 else i - 1}, {i}, count(*) FILTER (p_partkey % 3 = 2), 0::BIGINT FROM part"
       for n, i in _PLACES]
    + ["SELECT 'c', 'note, more', 'extra', 6, NULL, count(*) FILTER (p_partkey % 3 = 2), 0::BIGINT FROM part"]
)


@query("csv_drift", _DRIFT_SQL)
def csv_drift(spark, sf):
    """Per-file report over a glob, summed by layout: columns missing, extra,
    moved, and values that do not parse."""
    report = drift.file_drift(spark, _drifted_files(spark, sf), PART_SCHEMA)
    layout = F.regexp_extract("file", r"/([abc])/[^/]*$", 1).alias("layout")
    return report.groupBy(layout, "column_name", "status", "position", "expected_position").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_unparsed").alias("n_unparsed")
    )


@query(
    "csv_drift_read",
    "SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE p_brand END AS p_brand, p_type, "
    "CASE WHEN p_partkey % 3 = 1 AND p_size % 7 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice, "
    "CASE WHEN p_partkey % 3 = 1 AND p_size % 7 = 0 THEN 'p_size' ELSE '' END AS bad FROM part",
)
def csv_drift_read(spark, sf):
    """The same files as one table, each by its own header."""
    back = drift.read_csv_drifted(spark, _drifted_files(spark, sf), PART_SCHEMA, bad_values="bad")
    return back.withColumn("bad", F.array_join("bad", ","))


# ---------------------------------------------------------------------------
# 2.2 stratum keys that never collide
# ---------------------------------------------------------------------------

_A = "replace(o_orderpriority, '5-LOW', 'a\\-')"
_B = "nullif(o_orderstatus, 'F')"


def _escaped_sql(x: str) -> str:
    return f"coalesce(replace(replace({x}, '\\', '\\\\'), '-', '\\-'), '\\N')"


@query(
    "strata_key_exact",
    f"SELECT o_orderkey, concat({_escaped_sql(_A)}, '-', {_escaped_sql(_B)}) AS strata, {_A} AS part_a, {_B} AS part_b FROM orders",
)
def strata_key_exact(spark, sf):
    """Keys of values that hold the separator, the escape sign and NULL; the
    parts are read back off the key."""
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("a\\-")).alias("a"),
        F.nullif("o_orderstatus", F.lit("F")).alias("b"),
    )
    keyed = strata.add_exact_strata(o, ["a", "b"], "strata", sep="-").drop("a", "b")
    return strata.split_strata(keyed, "strata", ["part_a", "part_b"], sep="-")
