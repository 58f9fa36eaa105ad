"""Queries on column statistics: summaries with exact quantiles, fits that
merge, and the frequency index beyond the broadcast bound."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from strata_engine.functions.numeric import round_half_away
from strata_engine.operators import moments, scale, strata, summary
from strata_engine.plans.queries import DEC, LINEITEM_COLS, query, table
from strata_engine.session import BROADCAST_ROWS_KEY, materialize, scratch_path
from strata_engine.sources import writers

# ---------------------------------------------------------------------------
# 2.7 summary of all columns with exact quantiles
# ---------------------------------------------------------------------------

_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _summary_sql(columns: dict[str, str], source: str, quantiles: dict[str, float]) -> str:
    parts = []
    for i, (c, kind) in enumerate(columns.items()):
        head = f"SELECT {i}::INT AS position, '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS count, "
        if kind in ("bigint", "int", "double"):
            picks = ", ".join(f"quantile_disc({c}, {q})::DOUBLE AS {n}" for n, q in quantiles.items())
            body = (
                f"round(avg({c}::DOUBLE), {DEC}) AS mean, round(stddev_samp({c}::DOUBLE), {DEC}) AS stddev, min({c})::DOUBLE AS min, "
                f"max({c})::DOUBLE AS max, {picks}, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text"
            )
        else:
            nothing = ", ".join(f"NULL::DOUBLE AS {n}" for n in ("mean", "stddev", "min", "max", *quantiles))
            body = f"{nothing}, min({c})::VARCHAR AS min_text, max({c})::VARCHAR AS max_text"
        parts.append(f"{head}{body} FROM {source}")
    return " UNION ALL ".join(parts)


_LINEITEM_NULLS = (
    "(SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_returnflag, 'A') AS l_returnflag, "
    "CASE WHEN l_linenumber > 1 THEN 7 ELSE l_suppkey END AS l_suppkey) FROM lineitem)"
)


@query("summary_quantiles", _summary_sql(_TYPES, _LINEITEM_NULLS, {"p25": 0.25, "p50": 0.5, "p75": 0.75}))
def summary_quantiles(spark, sf):
    """All columns of ``lineitem`` of all types in one call, with exact
    quartiles; some values are NULL, and most of one column are alike."""
    li = table(spark, sf, "lineitem").withColumns({
        "l_discount": F.nullif("l_discount", F.lit(0.0)),
        "l_returnflag": F.nullif("l_returnflag", F.lit("A")),
        "l_suppkey": F.when(F.col("l_linenumber") > 1, F.lit(7)).otherwise(F.col("l_suppkey")).cast("bigint"),
    })
    return summary.summary(li, LINEITEM_COLS, decimals=DEC)


_TAILS = {"p0": 0.0, "p0_1": 0.001, "p50": 0.5, "p99_9": 0.999, "p100": 1.0}


@query(
    "summary_tails",
    _summary_sql({"o_totalprice": "double", "o_custkey": "bigint", "o_orderkey": "bigint"}, "orders", _TAILS),
)
def summary_tails(spark, sf):
    """Quantiles far out, with sketches so coarse that the written candidates
    are many."""
    cols = ["o_totalprice", "o_custkey", "o_orderkey"]
    return summary.summary(table(spark, sf, "orders"), cols, list(_TAILS.values()), decimals=DEC, accuracy=50)


# ---------------------------------------------------------------------------
# 2.5 fits that merge
# ---------------------------------------------------------------------------

_MOMENT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "far"]
_FAR = "1000000000 + l_quantity"
# a mean of 10^9 has seven digits behind the point, the last ones by chance
_FAR_DEC = 3


def _moments_sql(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), {_FAR_DEC}) AS mean, round(stddev_samp({c}), {_FAR_DEC}) AS stddev, "
        f"min({c}) AS min, max({c}) AS max{extra} FROM {source}"
        for c in _MOMENT_COLS
    )


_MOMENT_SOURCE = f"(SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, {_FAR} AS far FROM lineitem)"


def _moment_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumns({"l_discount": F.nullif("l_discount", F.lit(0.0)), "far": F.expr(_FAR)})


def _told(merged):
    rounded = {c: round_half_away(c, _FAR_DEC) for c in ("mean", "stddev")}
    return merged.withColumns(rounded).select("column_name", "n", "mean", "stddev", "min", "max")


@query("moments_merge", _moments_sql(_MOMENT_SOURCE))
def moments_merge(spark, sf):
    """Moments fitted on two halves apart, saved, and merged: those of the
    whole, also of a column whose mean is large against its spread."""
    li = _moment_rows(spark, sf)
    halves = [materialize(moments.moments(li.where(w), _MOMENT_COLS), "half") for w in ("l_orderkey % 3 = 0", "l_orderkey % 3 <> 0")]
    return _told(moments.merge(halves[0].unionByName(halves[1])))


@query("moments_update", _moments_sql(_MOMENT_SOURCE, ", 0 AS old_files_read"))
def moments_update(spark, sf):
    """A folder of files is fitted, more files come in, and the fit is brought
    up to date from those alone (``old_files_read``)."""
    li, data = _moment_rows(spark, sf), scratch_path(spark, "moment_files")
    store = moments.MomentStore(spark, scratch_path(spark, "moment_store"), _MOMENT_COLS)
    writers.save_parquet(li.where("l_linenumber <= 2"), data, ["l_linenumber"], cluster_by=())
    store.update(data)
    old = set(store.last_read)
    writers.save_parquet(li.where("l_linenumber > 2"), data, ["l_linenumber"], mode="append", cluster_by=())
    merged = store.update(data)
    return _told(merged).withColumn("old_files_read", F.lit(len(old & set(store.last_read))))


@query(
    "scale_from_moments",
    "SELECT o_orderkey, round((o_totalprice - mn) / (mx - mn), 6) AS o_totalprice_normalized, "
    "round((o_totalprice - mean) / sd, 6) AS o_totalprice_standardized FROM orders, "
    "(SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd FROM orders)",
)
def scale_from_moments(spark, sf):
    """Min-max and z-score by a fit that was merged from one part per order
    status; the table itself is read once, for the result."""
    o = table(spark, sf, "orders")
    parts = materialize(moments.moments(o, ["o_totalprice"], part="o_orderstatus"), "status_moments")
    fitted = moments.to_fit(moments.merge(parts), ["o_totalprice"])
    out = scale.scale(o, ["o_totalprice"], ("min_max", "z_score"), decimals=DEC, fitted=fitted)
    return out.select("o_orderkey", "o_totalprice_normalized", "o_totalprice_standardized")


# ---------------------------------------------------------------------------
# 2.5 the frequency index beyond the broadcast bound
# ---------------------------------------------------------------------------


@contextmanager
def _setting(spark, key, value):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@query(
    "string_index_wide",
    "SELECT l_orderkey, l_linenumber, l_partkey, part_index FROM lineitem JOIN (SELECT l_partkey, "
    "(row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1)::DOUBLE AS part_index FROM lineitem GROUP BY l_partkey) "
    "USING (l_partkey)",
)
def string_index_wide(spark, sf):
    """The frequency index of a column with more values than the session's
    broadcast bound (lowered here): labels are ranked across tasks and
    joined by a shuffle."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    with _setting(spark, BROADCAST_ROWS_KEY, "100"):
        return strata.frequency_index(li, "l_partkey", "part_index")
