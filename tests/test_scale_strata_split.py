import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata_engine.functions.hashing import hash_hex
from strata_engine.operators import ranking, report, scale, split, strata


def test_min_max_and_z_semantics(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5), (None, 5)], "x double, c int")
    out = scale.scale(df, ["x", "c"], ("min_max", "z_score")).collect()
    xs = [r.x_normalized for r in out]
    assert xs[:3] == [0.0, 1 / 3, 1.0] and xs[3] is None
    assert {r.c_normalized for r in out} == {0.5}       # constant column
    assert {r.c_standardized for r in out} == {0.0}
    z = [r.x_standardized for r in out[:3]]
    assert abs(sum(z)) < 1e-12


def test_chained_equals_z_of_normalized(spark):
    rows = [(float(random.Random(i).gauss(50, 9)),) for i in range(500)]
    df = spark.createDataFrame(rows, "x double")
    chained = scale.min_max_z(df, ["x"]).toPandas()
    n = chained["x_normalized"]
    expected = (n - n.mean()) / n.std(ddof=1)
    assert (chained["x_standardized"] - expected).abs().max() < 1e-9
    assert n.min() == 0.0 and n.max() == 1.0


def test_matches_ml_library(spark):
    from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(float(i * i % 17),) for i in range(200)], "x double")
    v = VectorAssembler(inputCols=["x"], outputCol="v").transform(df)
    mm = MinMaxScaler(inputCol="v", outputCol="n").fit(v).transform(v)
    ss = StandardScaler(inputCol="n", outputCol="s", withMean=True, withStd=True).fit(mm).transform(mm)
    ml = ss.select(vector_to_array("n")[0].alias("n"), vector_to_array("s")[0].alias("s")).toPandas()
    ours = scale.min_max_z(df, ["x"]).toPandas()
    assert (ml["n"] - ours["x_normalized"]).abs().max() < 1e-12
    assert (ml["s"] - ours["x_standardized"]).abs().max() < 1e-9


def test_missing_sentinel_treated_as_null(spark):
    df = spark.createDataFrame([(-9.0,), (0.0,), (10.0,)], "x double")
    got = [r.x_normalized for r in scale.min_max(df, ["x"], missing=-9).collect()]
    assert got == [None, 0.0, 1.0]


def test_strata_null_collision_and_token(spark):
    df = spark.createDataFrame([(1, None, 2), (1, 2, None)], "a int, b int, c int")
    plain = [r.s for r in strata.add_strata(df, ["a", "b", "c"], "s").collect()]
    assert plain == ["1_2", "1_2"]
    tok = [r.s for r in strata.add_strata(df, ["a", "b", "c"], "s", null_token="NA").collect()]
    assert tok == ["1_NA_2", "1_2_NA"]


def test_frequency_index_order_and_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("c",), ("b",), ("a",)], "s string")
    idx = {r.s: r.i for r in strata.frequency_index(df, "s", "i").collect()}
    assert idx == {"c": 0.0, "a": 1.0, "b": 2.0}  # equal counts: alphabetical first


def test_frequency_index_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "s string")
    with pytest.raises(strata.NullLabel):
        strata.frequency_index(df, "s", "i")
    keep = {r.s: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep").collect()}
    assert keep == {"a": 0.0, "b": 1.0, None: 2.0}
    assert strata.frequency_index(df, "s", "i", on_null="skip").count() == 3


def test_dense_index_large_path_equals_small_path(spark):
    df = spark.range(5000).select(F.col("id"), ((F.col("id") * 7919) % 613).alias("k"))
    order = [F.col("k").desc(), F.col("id").asc()]
    small = {r.id: r["index"] for r in ranking.dense_index(df, order, small=True).collect()}
    large = {r.id: r["index"] for r in ranking.dense_index(df.repartition(6), order, small=False).collect()}
    assert small == large
    assert sorted(small.values()) == list(range(5000))


def _brute_force_split(pdf, strata_col, key, weights, seed=42):
    import hashlib

    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        cuts.append(acc / sum(weights))
    names = ["train", "validation", "test"]
    out = {}
    for _, g in pdf.groupby(strata_col, dropna=False):
        g = g.assign(h=[hashlib.md5(f"{seed}-{k}".encode()).hexdigest() for k in g[key]])
        g = g.sort_values(["h", key])
        n = len(g)
        for rn, k in enumerate(g[key], start=1):
            arm = sum(rn > int((c * n + 0.5) // 1) for c in cuts)
            out[k] = names[arm]
    return out


def test_stratified_small_strata(spark):
    rows = [(s, i) for s, n in (("one", 1), ("two", 2), ("three", 3), ("four", 4)) for i in range(n)]
    df = spark.createDataFrame([(s, f"{s}{i}") for s, i in rows], "s string, k string")
    got = split.stratified_split(df, "s", ["k"]).groupBy("s", "split").count().collect()
    c = {(r.s, r.split): r["count"] for r in got}
    arms = lambda s: tuple(c.get((s, a), 0) for a in ("train", "validation", "test"))
    assert arms("one") == (1, 0, 0)
    assert arms("two") == (1, 1, 0)
    assert arms("three") == (2, 0, 1)
    assert arms("four") == (2, 1, 1)


@pytest.mark.parametrize("target", [1, 7, 100_000])
def test_stratified_skewed_matches_brute_force(spark, target):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        s = "hot" if i % 3 == 0 else f"s{rnd.randint(0, 40)}"   # a third of rows in one stratum
        rows.append((s, i))
    rows.append((None, 99999))
    df = spark.createDataFrame(rows, "s string, k long").repartition(5)
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=target).collect()}
    expected = _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))
    assert got == expected
    again = {r.k: r.split for r in split.stratified_split(df.repartition(3), "s", ["k"], target_rows=target).collect()}
    assert again == got


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = split.hash_split(df, ["k"])
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000
    assert abs(counts["train"] / 20000 - 0.6) < 0.02
    b = split.hash_split(df.repartition(9), ["k"])
    assert a.exceptAll(b).count() == 0


def test_random_split_forms(spark):
    df = spark.range(3000)
    parts = split.three_way(df)
    assert sum(p.count() for p in parts.values()) == 3000
    col = split.random_split_column(df)
    assert col.filter(F.col("split").isNull()).count() == 0 and col.count() == 3000


def test_split_report_shares(spark):
    df = spark.createDataFrame([("train", "a")] * 3 + [("test", "a"), ("test", "b")], "split string, s string")
    rep = {(r.split, r.strata): r for r in report.split_report(df, "split", "s").collect()}
    assert rep[("train", "a")].share_of_split == 1.0
    assert rep[("test", "a")].share_of_strata == 0.25
    assert rep[("test", "b")].share_of_split == 0.5


def test_hash_hex_matches_python_md5(spark):
    import hashlib

    got = spark.createDataFrame([(12,)], "k long").select(hash_hex(["k"], 42).alias("h")).first().h
    assert got == hashlib.md5(b"42-12").hexdigest()


@pytest.fixture()
def tiny_broadcast_bound(spark):
    from strata_engine.session import BROADCAST_ROWS_KEY

    spark.conf.set(BROADCAST_ROWS_KEY, "3")
    yield
    spark.conf.unset(BROADCAST_ROWS_KEY)


def test_frequency_index_over_bound_path(spark, tiny_broadcast_bound):
    df = spark.createDataFrame([(s,) for s in "aabbbcdddde"] + [(None,)], "s string")
    idx = {r.s: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep").collect()}
    assert idx == {"d": 0.0, "b": 1.0, "a": 2.0, "c": 3.0, "e": 4.0, None: 5.0}


def test_stratified_over_bound_path(spark, tiny_broadcast_bound):
    rows = [(f"s{i % 7}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "s string, k long")
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=3).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))


def test_safe_casts_match_try_cast(spark):
    from strata_engine.functions.casts import safe_cast

    df = spark.createDataFrame(
        [(3000000000, 2147483647.7, "2147483648", " 12"), (-5, -2147483648.9, "0000001", ""),
         (None, float("nan"), "99999999999999999999", "x1")],
        "l bigint, d double, s string, t string",
    )
    for c, t in (("l", "bigint"), ("d", "double"), ("s", "string"), ("t", "string")):
        got = [r[0] for r in df.select(safe_cast(c, "int", t)).collect()]
        want = [r[0] for r in df.select(F.col(c).try_cast("int")).collect()]
        assert got == want, c


@pytest.fixture()
def no_inline(monkeypatch):
    import strata_engine.operators.strata as T

    monkeypatch.setattr(T, "INLINE_KEYS", 0)


def test_broadcast_join_paths(spark, no_inline):
    rows = [(None if i % 97 == 0 else f"s{i % 9}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, k long")
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=3).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))
    idx = {r.s: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep").collect()}
    assert idx[None] == 9.0 and sorted(v for k, v in idx.items() if k is not None) == [float(i) for i in range(9)]


@pytest.mark.parametrize("target", [1, 20, 150, 10_000_000])
def test_stratified_adaptive_digits_match_brute_force(spark, target):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"s{rnd.randint(0, 60)}", i) for i in range(5000)] + [(None, 77777)]
    df = spark.createDataFrame(rows, "s string, k long").repartition(4)
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=target).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))


def test_stratified_adaptive_over_bound(spark, tiny_broadcast_bound):
    rows = [(f"s{i % 7}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "s string, k long")
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=10).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))


def test_stratified_adaptive_broadcast_path(spark, no_inline):
    rows = [(None if i % 97 == 0 else f"s{i % 9}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, k long")
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], target_rows=15).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", (0.6, 0.2, 0.2))


def test_shared_value_counts(spark):
    rows = [("hot" if i % 3 == 0 else f"s{i % 11}", i) for i in range(1200)] + [(None, 5555)]
    df = spark.createDataFrame(rows, "s string, k long")
    counts = strata.value_counts(df, "s")
    assert counts[None] == 1 and sum(counts.values()) == 1201
    a = {r.k: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep", counts=counts).collect()}
    b = {r.k: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep").collect()}
    assert a == b


@pytest.mark.parametrize("n_values", [3, 200])
def test_stratum_types(spark, n_values):
    """Date, timestamp and decimal strata, few and many, split as their text does."""
    df = spark.range(1200).select(F.col("id").alias("k"), (F.col("id") % n_values).cast("int").alias("v"))
    df = df.withColumns({
        "as_date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v")),
        "as_time": F.timestamp_seconds(F.col("v") * 3600),
        "as_decimal": (F.col("v") / 4).cast("decimal(12,2)"),
    })
    want = {r.k: r.split for r in split.stratified_split(df, "v", ["k"]).collect()}
    for c in ("as_date", "as_time", "as_decimal"):
        assert {r.k: r.split for r in split.stratified_split(df, c, ["k"]).collect()} == want, c


def test_stratified_reads_wide_table_once_without_shuffle(spark, tmp_path):
    wide = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("s"), *[F.rand(i).alias(f"w{i}") for i in range(8)])
    wide.write.parquet(str(tmp_path / "wide"))
    plan = split.stratified_split(spark.read.parquet(str(tmp_path / "wide")), "s", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("w7#") and sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 0
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "w7" in scans[0]  # the boundaries are a local table


def test_duplicate_keys_stay_together(spark):
    df = spark.createDataFrame([("a", i // 3) for i in range(300)], "s string, k long")
    got = split.stratified_split(df, "s", ["k"], target_rows=5)
    assert got.count() == 300 and got.groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_value_counts_over_bound_are_shared(spark, tiny_broadcast_bound):
    df = spark.createDataFrame([(s,) for s in "aabbbcdddde"] + [(None,)], "s string")
    counts = strata.value_counts(df, "s")
    assert not isinstance(counts, dict)
    idx = {r.s: r.i for r in strata.frequency_index(df, "s", "i", on_null="keep", counts=counts).collect()}
    assert idx == {"d": 0.0, "b": 1.0, "a": 2.0, "c": 3.0, "e": 4.0, None: 5.0}
