"""Moments that merge, and their store over a growing folder."""

from __future__ import annotations

import math
import random
import statistics

import pytest

from strata_engine.operators import moments, scale


def rows_of(merged):
    return {r["column_name"]: r for r in merged.collect()}


def check(r, values):
    held = [v for v in values if v is not None]
    assert r["n"] == len(held)
    if not held:
        assert r["mean"] is r["stddev"] is r["min"] is None
        return
    assert r["min"] == min(held) and r["max"] == max(held)
    assert math.isclose(r["mean"], statistics.fmean(held), rel_tol=1e-12, abs_tol=1e-9)
    if len(held) > 1:
        assert math.isclose(r["stddev"], statistics.stdev(held), rel_tol=1e-9, abs_tol=1e-9)
    else:
        assert r["stddev"] is None


def test_merged_parts_equal_the_whole(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, rng.gauss(1e9, 1)]), float(k % 3 == 0), None, -9.0) for k in range(400)]
    rows += [("one", 5.0, None, None, 3.0), ("empty", None, None, None, None)]
    df = spark.createDataFrame(rows, "p string, x double, y double, z double, m double")
    cols = ["x", "y", "z", "m"]
    by_part = moments.moments(df, cols, part="p", missing=-9)
    assert by_part.count() == 4 * 6
    got = rows_of(moments.merge(by_part))
    for i, c in enumerate(cols, 1):
        check(got[c], [None if r[i] == -9 else r[i] for r in rows])
    single = rows_of(moments.merge(moments.moments(df, cols, missing=-9)))
    assert math.isclose(single["x"]["stddev"], got["x"]["stddev"], rel_tol=1e-9)
    assert moments.moments(df, []).count() == 0 and moments.merge(moments.moments(df.limit(0), cols, part="p")).count() == 0


def test_scaling_by_a_merged_fit_needs_no_job_on_the_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    fitted = moments.to_fit(moments.merge(moments.moments(df, ["v"])), ["v"])
    kinds = ("min_max", "min_max_z")
    a, b = (scale.scale(df, ["v"], kinds, decimals=9, fitted=f).collect() for f in (fitted, None))
    assert a == b
    with pytest.raises(KeyError):
        moments.to_fit(moments.merge(moments.moments(df, ["v"])), ["w"])


def test_store_reads_new_and_changed_files_only(spark, tmp_path):
    data, read = str(tmp_path / "da ta"), []

    def reader(paths):
        read.append(len(paths))
        return spark.read.parquet(*paths)

    def save(values, name):
        spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).write.mode("overwrite").parquet(f"{data}/k={name}")

    store = moments.MomentStore(spark, str(tmp_path / "store"), ["v"], reader)
    save([1.0, 2.0], "a b")
    save([10.0, None], "b")
    check(rows_of(store.update(data))["v"], [1.0, 2.0, 10.0])
    check(rows_of(store.update(data))["v"], [1.0, 2.0, 10.0])
    assert read == [2] and store.last_read == []
    save([], "c")
    save([7.0], "d")
    check(rows_of(store.update(data))["v"], [1.0, 2.0, 10.0, 7.0])
    save([100.0, 200.0, 300.0], "b")  # another file in its place
    again = moments.MomentStore(spark, str(tmp_path / "store"), ["v"], reader)
    check(rows_of(again.update(data))["v"], [1.0, 2.0, 7.0, 100.0, 200.0, 300.0])
    assert read == [2, 2, 1]
    check(rows_of(again.update(data))["v"], [1.0, 2.0, 7.0, 100.0, 200.0, 300.0])
    assert read == [2, 2, 1]
