"""Files of differing layouts, salted saves, stratum keys that never collide."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata_engine.operators import strata
from strata_engine.session import BROADCAST_ROWS_KEY
from strata_engine.sources import drift, readers, writers

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("v", DoubleType())])


@pytest.fixture()
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.csv").write_bytes(text.encode())
        return f"{tmp_path}/*.csv"

    return write


def test_drift_report_per_file(spark, folder):
    glob = folder(
        same="id,name,v\n1,a,1.5\n2,b,x\n,,\n",
        moved='﻿v,"name",id\r\n2.5,"c, d",3\r\nbad,e,99999999999\r\n',
        other='id,"more, \\"so\\"",v,more\n7,z,0.5,1\n7,z,0.5,1\n',
        header="id,name,v\n",
        nothing="",
    )
    got = {}
    for r in drift.file_drift(spark, glob, SCHEMA).collect():
        got.setdefault(os.path.basename(r.file)[:-4], {})[r.column_name] = (r.status, r.position, r.expected_position, r.n_rows, r.n_unparsed)
    assert got == {
        "same": {"id": ("ok", 1, 1, 3, 0), "name": ("ok", 2, 2, 3, 0), "v": ("ok", 3, 3, 3, 1)},
        "moved": {"id": ("moved", 3, 1, 2, 1), "name": ("ok", 2, 2, 2, 0), "v": ("moved", 1, 3, 2, 1)},
        "other": {
            "id": ("ok", 1, 1, 2, 0), "name": ("missing", None, 2, 2, 0), "v": ("ok", 3, 3, 2, 0),
            'more, "so"': ("extra", 2, None, 2, 0), "more": ("extra", 4, None, 2, 0),
        },
        "header": {"id": ("ok", 1, 1, 0, 0), "name": ("ok", 2, 2, 0, 0), "v": ("ok", 3, 3, 0, 0)},
    }
    rows = drift.read_csv_drifted(spark, glob, SCHEMA, bad_values="bad").collect()
    assert Counter((r.id, r.name, r.v, tuple(r.bad)) for r in rows) == Counter([
        (1, "a", 1.5, ()), (2, "b", None, ("v",)), (None, None, None, ()), (3, "c, d", 2.5, ()), (None, "e", None, ("id", "v")),
        (7, None, 0.5, ()), (7, None, 0.5, ()),
    ])


def test_drift_without_the_broadcast_and_of_long_files(spark, folder):
    lines = [f"{k},n{k},{k}.5" for k in range(4_000)]
    glob = folder(a="id,name,v\n" + "\n".join(lines[:3_000]), b="v,id\n" + "\n".join(f"{k}.5,{k}" for k in range(3_000, 4_000)))
    spark.conf.set(BROADCAST_ROWS_KEY, "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = drift.read_csv_drifted(spark, glob, SCHEMA)
        assert sorted((r.id, r.name, r.v) for r in got.collect()) == [(k, f"n{k}" if k < 3_000 else None, k + 0.5) for k in range(4_000)]
        assert {(r.column_name, r.status, r.n_rows) for r in drift.file_drift(spark, glob, SCHEMA).collect() if r.file.endswith("b.csv")} == {
            ("id", "moved", 1_000), ("name", "missing", 1_000), ("v", "moved", 1_000),
        }
    finally:
        spark.conf.unset(BROADCAST_ROWS_KEY)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("bound", ["100000", "0"])
def test_salted_save_keeps_rows_and_bounds_files(spark, tmp_path, bound):
    rng = random.Random(6)
    rows = [("hot", k, "x") for k in range(3_000)] + [("copies", 1, "same")] * 1_500 + [(None, k, "n") for k in range(700)]
    rows += [(f"k{k % 40}", k, None) for k in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v int, s string").repartition(8).withColumn("m", F.create_map(F.lit(1), F.col("v")))
    path = str(tmp_path / "out")
    spark.conf.set(BROADCAST_ROWS_KEY, bound)
    try:
        writers.save_salted(df, path, ["k"], rows_per_file=500)
    finally:
        spark.conf.unset(BROADCAST_ROWS_KEY)
    back = readers.read_parquet(spark, path)
    assert Counter((r.k, r.v, r.s) for r in back.collect()) == Counter(rows)
    files = Counter()
    for r in back.groupBy("k", F.col("_metadata.file_path").alias("f")).count().collect():
        assert r["count"] <= 500
        files[r.k] += 1
    assert all(files[f"k{i}"] == 1 for i in range(40))
    assert 6 <= files["hot"] <= 16 and files[None] <= 4 and files["copies"] <= 12
    writers.save_salted(df.limit(0), path, ["k"], rows_per_file=500)
    with pytest.raises(ValueError):
        writers.save_salted(df, path, ["k"], rows_per_file=0)


PARTS = st.lists(st.tuples(*[st.one_of(st.none(), st.text(alphabet="a_\\N-\n é", max_size=5))] * 3), min_size=2, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PARTS, st.sampled_from(["_", "-", "|", "^", "]", "."]))
def test_exact_strata_never_collide_and_come_apart(spark, rows, sep):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    keyed = strata.add_exact_strata(df, ["a", "b", "c"], "key", sep)
    got = strata.split_strata(keyed, "key", ["x", "y", "z"], sep).collect()
    assert all((r.a, r.b, r.c) == (r.x, r.y, r.z) for r in got)
    assert len({r.key for r in got}) == len(set(rows)) and all(r.key is not None for r in got)


def test_exact_strata_of_plain_values_and_odd_separators(spark):
    df = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 1)], "p string, q string, n int")
    keys = [r.k for r in strata.add_exact_strata(df, ["p", "q", "n"], "k").collect()]
    assert keys == ["a\\_b_c_1", "a_b\\_c_1"]
    same = strata.add_strata(strata.add_exact_strata(df, ["p", "n"], "k", "|"), ["p", "n"], "old", "|").collect()
    assert all(r.k == r.old for r in same)
    for sep in ("__", "\\", "N", ""):
        with pytest.raises(ValueError):
            strata.exact_strata_expr(["p"], sep)
    with pytest.raises(ValueError):
        strata.exact_strata_expr([])


def test_frequency_index_beyond_the_bound_equals_the_local_one(spark):
    rng = random.Random(1)
    rows = [(k, "hot" if rng.random() < 0.4 else f"v{rng.randrange(60)}") for k in range(600)]
    df = spark.createDataFrame(rows, "k int, v string")
    near = {r.k: r.i for r in strata.frequency_index(df, "v", "i").collect()}
    spark.conf.set(BROADCAST_ROWS_KEY, "5")
    try:
        far = {r.k: r.i for r in strata.frequency_index(df, "v", "i").collect()}
    finally:
        spark.conf.unset(BROADCAST_ROWS_KEY)
    assert near == far
