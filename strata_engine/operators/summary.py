"""``summary()`` of all columns of a table in one call, with exact quantiles.

The library call gives approximate percentiles, as text. Here a quantile is
the value of a row: of n values in order, the one at rank ``ceil(q * n)`` (at
least 1). It is found by narrowing, in two scans of the table whatever its
size and however many columns and quantiles are asked for:

1. One aggregate: counts, moments, extremes, and per column a mergeable
   sketch that says within which two values each rank lies (with its error
   added on both sides).
2. One aggregate by column and region: values between two such brackets are
   only counted; values inside a bracket are counted one by one. The counts
   tell how far into its bracket each rank is. The counted values (about
   4 / ``accuracy`` of the rows for each quantile, at most one row a
   distinct value) are written once.

The value at each rank is then picked from the counted values by a running
sum, in one window if they are few and across range-sorted tasks if not. A
rank that a sketch has missed is looked for in the whole range of its column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, MapType, NumericType, StructField, StructType, VariantType

from strata_engine.functions.numeric import round_half_away
from strata_engine.operators.ranking import running_sum
from strata_engine.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def quantile_name(q: float) -> str:
    """p25, p50, p99_9, ..."""
    return "p" + f"{100 * q:.10f}".rstrip("0").rstrip(".").replace(".", "_")


def _rank(q: float, n: int) -> int:
    """ceil(q * n), at least 1; from above, so that q = 1 is n."""
    return max(1, n - math.floor(n - n * q))


def _is_number(kind) -> bool:
    return isinstance(kind, (NumericType, DecimalType))


def summary(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    quantiles: Sequence[float] = QUARTILES,
    decimals: int | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per column (default: all, in order): position, column_name,
    data_type, count (values that are not NULL), and

    * of number columns mean, stddev (sample), min, max and a column per
      quantile (``p25``, ``p50``, ...), all doubles (``decimals`` rounds mean
      and stddev);
    * of other columns min_text and max_text, the extremes in the column's
      order as text (NULL where the type has no order).

    What a column has no values for is NULL. NaN is the largest value, as in
    Spark's order. ``accuracy`` sets the sketches' size; it changes the work,
    never the result. Nested fields are not looked into."""
    fields = {f.name: f for f in df.schema.fields}
    names = list(fields) if cols is None else list(cols)
    if any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError("quantiles must be 0 to 1")
    numbers = [c for c in names if _is_number(fields[c].dataType)]
    x = {c: F.col(f"`{c}`").cast("double") for c in numbers}

    slack = 2.0 / accuracy
    ends = [min(1.0, max(0.0, q + s)) for q in quantiles for s in (-slack, slack)]
    aggs = []
    for i, c in enumerate(names):
        value = F.col(f"`{c}`")
        aggs.append(F.count(value).alias(f"n{i}"))
        if c in x:
            aggs += [F.avg(x[c]).alias(f"mean{i}"), F.stddev_samp(x[c]).alias(f"sd{i}"), F.min(x[c]).alias(f"min{i}"), F.max(x[c]).alias(f"max{i}")]
            if quantiles:
                aggs.append(F.percentile_approx(x[c], ends, accuracy).alias(f"ends{i}"))
        elif not isinstance(fields[c].dataType, (MapType, VariantType)):
            aggs += [F.min(value).cast("string").alias(f"min{i}"), F.max(value).cast("string").alias(f"max{i}")]
    found = df.agg(*aggs).first().asDict() if aggs else {}

    at = {c: i for i, c in enumerate(names)}
    brackets = {}
    for c in numbers:
        if quantiles and found[f"n{at[c]}"]:
            e = found[f"ends{at[c]}"]
            brackets[c] = [(e[2 * k], e[2 * k + 1]) for k in range(len(quantiles))]
    ranks = {c: [_rank(q, found[f"n{at[c]}"]) for q in quantiles] for c in brackets}
    picked, missed = _select(df, x, brackets, ranks)
    if missed:
        whole = {c: [(found[f"min{at[c]}"], found[f"max{at[c]}"])] for c in missed}
        again, _ = _select(df, x, whole, {c: ranks[c] for c in missed})
        picked |= again

    rows = []
    for i, c in enumerate(names):
        get = lambda k: found.get(f"{k}{i}")  # noqa: E731, B023
        if c in x:
            values = [picked.get((c, r)) for r in ranks.get(c, [None] * len(quantiles))]
            rows.append((i, c, fields[c].dataType.simpleString(), get("n"), get("mean"), get("sd"), get("min"), get("max"), *values, None, None))
        else:
            nothing = [None] * (4 + len(quantiles))
            rows.append((i, c, fields[c].dataType.simpleString(), get("n"), *nothing, get("min"), get("max")))
    told = ["mean double", "stddev double", "min double", "max double", *(f"{quantile_name(q)} double" for q in quantiles)]
    schema = ", ".join(["position int", "column_name string", "data_type string", "count bigint", *told, "min_text string", "max_text string"])
    out = df.sparkSession.createDataFrame(rows, schema)
    if decimals is not None:
        out = out.withColumns({c: round_half_away(c, decimals) for c in ("mean", "stddev")})
    return out


def _regions(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The brackets of a column in order, those that meet put together."""
    # NaN, the largest value, compares as infinity does beyond all numbers
    order = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets, key=lambda b: (order(b[0]), order(b[1]))):
        if out and order(lo) <= order(out[-1][1]):
            out[-1] = (out[-1][0], max(out[-1][1], hi, key=order))
        else:
            out.append((lo, hi))
    return out


def _region(x: Column, regions: list[tuple[float, float]]) -> Column:
    """2k + 1 inside the k-th bracket (from 0), 2k below it and above the one
    before."""
    code = F.lit(2 * len(regions))
    for k in range(len(regions) - 1, -1, -1):
        lo, hi = (F.lit(float(v)) for v in regions[k])
        code = F.when(x < lo, F.lit(2 * k)).when(x <= hi, F.lit(2 * k + 1)).otherwise(code)
    return code


def _select(
    df: DataFrame, x: dict[str, Column], brackets: dict[str, list[tuple[float, float]]], ranks: dict[str, list[int]]
) -> tuple[dict[tuple[str, int], float], list[str]]:
    """({(column, rank): value}, columns with a rank outside its brackets)."""
    if not brackets:
        return {}, []
    spark, names = df.sparkSession, list(brackets)
    regions = {c: _regions(brackets[c]) for c in names}
    cells = []
    for i, c in enumerate(names):
        code = _region(x[c], regions[c])
        cells.append(F.when(x[c].isNotNull(), F.struct(F.lit(i).alias("i"), code.alias("region"), F.when(code % 2 == 1, x[c]).alias("v"))))
    # one row per column and input row, merged at once: at most one per
    # column and gap, and one per value inside a bracket, leaves a task
    long = df.select(F.explode(F.array(*cells)).alias("c")).where(F.col("c").isNotNull()).select("c.*")
    counted = materialize(long.groupBy("i", "region", "v").agg(F.count(F.lit(1)).alias("n")), "quantile_values")
    sizes: dict[tuple[int, int], int] = {}
    for r in counted.groupBy("i", "region").agg(F.sum("n").alias("n")).collect():  # few brackets a column
        sizes[r["i"], r["region"]] = r["n"]

    wanted, missed = [], []
    for i, c in enumerate(names):
        upto = 0
        spans = []
        for region in range(2 * len(regions[c]) + 1):
            spans.append((region, upto, upto + sizes.get((i, region), 0)))
            upto = spans[-1][2]
        for rank in sorted(set(ranks[c])):
            region, before, _ = next(s for s in spans if s[1] < rank <= s[2])
            if region % 2:
                wanted.append((i, region, rank, rank - before))
            elif c not in missed:
                missed.append(c)
    if not wanted:
        return {}, missed
    inside = counted.where(F.col("region") % 2 == 1)
    running = running_sum(inside, ["i", "region"], [F.col("v")], "n", "upto")
    schema = StructType([StructField("i2", counted.schema["i"].dataType), *StructType.fromDDL("region2 int, rank bigint, want bigint").fields])
    # one row per column and quantile
    asked = F.broadcast(spark.createDataFrame(wanted, schema))
    here = (F.col("i") == F.col("i2")) & (F.col("region") == F.col("region2"))
    hit = running.join(asked, here & (F.col("want") <= F.col("upto")) & (F.col("want") > F.col("upto") - F.col("n")))
    return {(names[r["i"]], r["rank"]): r["v"] for r in hit.select("i", "rank", "v").collect()}, missed
