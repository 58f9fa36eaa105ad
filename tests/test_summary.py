"""Summaries with exact quantiles, running sums, against plain Python."""

from __future__ import annotations

import datetime
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata_engine.operators.ranking import running_sum
from strata_engine.operators.summary import _regions, quantile_name, summary
from strata_engine.session import BROADCAST_ROWS_KEY

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def brute(values, q):
    held = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
    return float(held[max(1, math.ceil(round(q * len(held), 9))) - 1]) if held else None


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.fixture()
def low_bound(spark):
    spark.conf.set(BROADCAST_ROWS_KEY, "3")
    yield
    spark.conf.unset(BROADCAST_ROWS_KEY)


def table(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        hot = rng.random() < 0.4
        rows.append((
            None if rng.random() < 0.1 else 7 if hot else rng.randrange(-(2**40), 2**40),
            rng.choice([None, float("nan"), 1e300, -1e300, -0.0]) if rng.random() < 0.2 else rng.gauss(0, 1),
            rng.randrange(5), None, Decimal(rng.randrange(10**6)) / 100, rng.choice(["a", "B", "é", None]),
            datetime.date(2020, 1, 1) + datetime.timedelta(days=k % 50), [k], {"k": k},
        ))
    schema = "a bigint, b double, c int, d double, e decimal(20,2), s string, t date, l array<int>, m map<string,int>"
    return rows, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("n, accuracy", [(400, 10_000), (1, 10), (2_500, 20)])
def test_summary_equals_sorting(spark, n, accuracy):
    rows, df = table(spark, n, n)
    got = summary(df, quantiles=QS, accuracy=accuracy).orderBy("position").collect()
    assert [r.column_name for r in got] == df.columns
    for i, r in enumerate(got[:5]):
        values = [row[i] for row in rows]
        assert r["count"] == sum(v is not None for v in values)
        for q in QS:
            assert same(r[quantile_name(q)], brute(values, q)), (r.column_name, q)
    text = {r.column_name: (r["count"], r.min_text, r.max_text, r.p50, r["mean"]) for r in got[5:]}
    strings = [row[5] for row in rows if row[5] is not None]
    assert text["s"] == (len(strings), min(strings, default=None), max(strings, default=None), None, None)
    assert text["t"][1] == "2020-01-01" and text["m"] == (n, None, None, None, None)


def test_summary_beyond_the_session_bound(spark, low_bound):
    rows, df = table(spark, 1_200, 8)
    got = {r.column_name: r for r in summary(df.repartition(5), ["a", "b", "c"], QS, accuracy=15).collect()}
    for i, c in enumerate("abc"):
        for q in QS:
            assert same(got[c][quantile_name(q)], brute([row[i] for row in rows], q)), (c, q)


def test_sketches_that_miss_are_made_good(spark, monkeypatch):
    """Brackets that lie beside the rank: it is looked for in the whole column."""
    values = [float(v) for v in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    monkeypatch.setattr(F, "percentile_approx", lambda c, ends, accuracy: F.array(*[F.max(c) * 0 + 1.5 for _ in ends]))
    r = summary(df).first()
    assert (r.p25, r.p50, r.p75) == (24.0, 49.0, 74.0)


def test_summary_of_nothing_and_bad_quantiles(spark):
    df = spark.createDataFrame([], "a int, s string")
    assert [(r["count"], r["p50"] if r.column_name == "a" else r.min_text) for r in summary(df).collect()] == [(0, None), (0, None)]
    odd = spark.createDataFrame([(1, 2)], "`a b` int, `x.y` int")
    assert [r.p50 for r in summary(odd).orderBy("position").collect()] == [1.0, 2.0]
    with pytest.raises(ValueError):
        summary(df, quantiles=[1.5])
    assert summary(spark.createDataFrame([(3,)], "a int"), quantiles=[]).columns[-3:] == ["max", "min_text", "max_text"]


def test_regions_merge_and_names():
    nan = float("nan")
    assert _regions([(5.0, 6.0), (1.0, 2.0), (2.0, 3.0)]) == [(1.0, 3.0), (5.0, 6.0)]
    assert len(_regions([(1.0, nan), (nan, nan)])) == 1
    assert [quantile_name(q) for q in (0.25, 0.999, 0, 1)] == ["p25", "p99_9", "p0", "p100"]


@pytest.mark.parametrize("small", [True, False])
def test_running_sum_on_one_and_many_tasks(spark, small, low_bound):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), k, rng.randrange(9)) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, n bigint").repartition(7)
    got = {r.k: r.upto for r in running_sum(df, ["g"], [F.col("k")], "n", small=small).collect()}
    assert got == {k: sum(n for h, j, n in rows if h == g and j <= k) for g, k, _ in rows}
