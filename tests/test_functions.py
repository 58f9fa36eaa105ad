from pyspark.sql import functions as F

from strata_engine.functions import rules as R
from strata_engine.functions.casts import id_suffix, lossless
from strata_engine.functions.codes import code_label
from strata_engine.functions.hashing import unit_hash
from strata_engine.functions.numeric import round_half_away


def test_code_label_default_null_and_sentinel(spark):
    df = spark.createDataFrame([(1,), (2,), (-9,), (7,), (None,)], "g int")
    m = {1: "Male", 2: "Female", -9: "Missing/unknown/not collected/invalid"}
    got = [r[0] for r in df.select(code_label("g", m, key_type="int")).collect()]
    assert got == ["Male", "Female", "Missing/unknown/not collected/invalid", "Unknown", "Unknown"]


def test_code_label_long_column(spark):
    df = spark.createDataFrame([(3000000000,), (1,)], "k bigint")
    got = [r[0] for r in df.select(code_label("k", {3000000000: "big"}, key_type="bigint")).collect()]
    assert got == ["big", "Unknown"]


def test_id_suffix_edges(spark):
    df = spark.createDataFrame([(20210000001,), (2021,), (20219999999999,), (None,)], "c bigint")
    got = [r[0] for r in df.select(id_suffix("c")).collect()]
    assert got == [1, None, None, None]


def test_lossless(spark):
    df = spark.createDataFrame([(1.0, 3000000000), (1.5, 1)], "x double, y bigint")
    got = df.select(lossless("x", "int").alias("a"), lossless("y", "int").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(True, None), (False, True)]


def test_rule_builders():
    assert R.in_range_or("AGE", 0, -9, name="non_negative_age") == {"non_negative_age": "`AGE` >= 0 OR `AGE` = -9"}
    assert list(R.at_least(["EDUC", "X"], -9, {"X": "own_name"})) == ["valid_educ_values", "own_name"]
    assert list(R.at_least(["TRAUSTREFLG"], -9, {"TRAUSTREFLG": "valid_traustref_values"})) == ["valid_traustref_values"]
    assert R.not_blank("s", "v") == {"v": "`s` IS NOT NULL AND `s` != ''"}
    assert R.conjunction({"a": "x > 1 OR y", "b": "z"}) == "(x > 1 OR y) AND (z)"


def test_unit_hash_range_and_stability(spark):
    df = spark.range(2000).select(unit_hash(["id"], 42).alias("u"))
    a = [r.u for r in df.collect()]
    b = [r.u for r in df.repartition(7).orderBy(F.lit(1)).collect()]
    assert all(0 <= u < 1 for u in a)
    assert sorted(a) == sorted(b)


def test_round_half_away(spark):
    df = spark.createDataFrame([(0.1234565,), (-0.0000004,), (2.5e-7,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 6)).collect()]
    assert got[0] == 0.123457 or got[0] == 0.123456  # binary representation decides
    assert got[1] == 0.0 and got[2] == 0.0 and got[3] is None


def test_code_label_escapes_and_types(spark):
    df = spark.createDataFrame([(1,), (-9,), (4,), (3000000000,)], "c bigint")
    m = {1: "O'Brien", -9: "back\\slash", 4: "Divorced, widowed", 3000000000: "big"}
    got = [r[0] for r in df.select(code_label("c", m, key_type="bigint")).collect()]
    assert got == ["O'Brien", "back\\slash", "Divorced, widowed", "big"]
    s = spark.createDataFrame([("it's",), ("a\\b",), ("z",)], "k string")
    got = [r[0] for r in s.select(code_label("k", {"it's": 1.5, "a\\b": 2.0}, None, "string")).collect()]
    assert got == [1.5, 2.0, None]


def test_map_codes_long_list_uses_join_with_same_result(spark):
    from strata_engine.operators.transform import MAP_LITERAL_MAX, map_codes

    df = spark.createDataFrame([(i,) for i in range(-10, 400)] + [(None,)], "c int")
    big = {i: f"L{i}" for i in range(MAP_LITERAL_MAX + 50)}
    got = {r.c: r.c_mapped for r in map_codes(df, {"c": big}).collect()}
    want = {c: big.get(c, "Unknown") for c in list(range(-10, 400)) + [None]}
    assert got == want
    plan = map_codes(df, {"c": big})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_scratch_goes_under_session_checkpoint_dir(spark):
    from strata_engine.session import checkpoint_root, materialize, scratch_path

    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and root == configured.rstrip("/")
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a.startswith(root + "/") and a != b
    m = materialize(spark.range(5), "probe")
    from urllib.parse import urlparse

    assert m.count() == 5 and urlparse(m.inputFiles()[0]).path.startswith(urlparse(root).path)


def test_round_half_away_large_and_special(spark):
    from strata_engine.functions.numeric import round_half_away

    values = [1e13, 2.5e15, 1e300, float("inf"), float("-inf"), 1.0000005, -2.5, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 6)).collect()]
    assert got[:5] == values[:5] and got[5] == 1.000001 and got[6:] == [-2.5, None]
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(round_half_away("x", 6)).first()[0]
    assert nan != nan


def test_code_types_on_both_sides_of_the_limit(spark):
    import datetime
    import decimal

    from strata_engine.operators.transform import MAP_LITERAL_MAX, AmbiguousCode, map_codes, map_codes_lookup

    day = datetime.date(2020, 1, 1)
    kinds = {
        "date": lambda i: day + datetime.timedelta(i),
        "timestamp_ntz": lambda i: datetime.datetime(2020, 1, 1, i % 24, i // 24),
        "decimal(10,2)": lambda i: decimal.Decimal(i) / 4,
        "bigint": lambda i: i + 2**40,
        "string": lambda i: f"it's {i}",
        "double": lambda i: i + 0.5,
    }
    for kind, make in kinds.items():
        rows = [(i, make(i)) for i in range(MAP_LITERAL_MAX + 40)] + [(-1, None)]
        df = spark.createDataFrame(rows, f"n int, c {kind}")
        for size in (3, MAP_LITERAL_MAX + 20):
            codes = {make(i): f"L{i}" for i in range(size)}
            got = {r.n: r.c_mapped for r in map_codes(df, {"c": codes}).collect()}
            assert got == {i: (f"L{i}" if 0 <= i < size else "Unknown") for i, _ in rows}, (kind, size)
    lookup = spark.createDataFrame([(1, "a"), (1, "b")], "code int, label string")
    try:
        map_codes_lookup(spark.createDataFrame([(1,)], "c int"), "c", lookup)
        raise AssertionError("two labels for one code must raise")
    except AmbiguousCode:
        pass


def test_broadcast_bound_counts_bytes(spark):
    from strata_engine.session import BROADCAST_BYTES_KEY, collect_small, fits_broadcast

    df = spark.createDataFrame([("x" * 1000, i) for i in range(50)], "s string, n int")
    assert fits_broadcast(df) and sorted(r.n for r in collect_small(df)) == list(range(50))
    spark.conf.set(BROADCAST_BYTES_KEY, "20000")
    try:
        assert not fits_broadcast(df) and collect_small(df) is None
        assert fits_broadcast(df.limit(5)) and len(collect_small(df.limit(5))) == 5
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_no_temporary_folder_off_local_masters(spark, monkeypatch):
    import pytest

    from strata_engine import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = Context()

    with pytest.raises(session.NoSharedFolder):
        session.checkpoint_root(Session())


def test_clean_scratch_removes_this_applications_tables(spark, tmp_path):
    import os
    from urllib.parse import urlparse

    from strata_engine import session

    written = session.materialize(spark.range(5), "gone")
    folder = urlparse(os.path.dirname(os.path.dirname(written.inputFiles()[0]))).path
    other = os.path.join(os.path.dirname(folder), f"another-{os.path.basename(str(tmp_path))}-{os.getpid()}")
    os.makedirs(other)
    session.clean_scratch(spark)
    assert not os.path.exists(folder) and os.path.isdir(other)
