import os

from pyspark.sql import functions as F

from strata_engine.plans import survey
from strata_engine.plans.layers import run_log
from strata_engine.sources import readers, writers


def test_csv_roundtrip_keeps_comma_labels(spark, tmp_path):
    df = spark.createDataFrame([(4, "Divorced, widowed"), (1, 'Say "hi"')], "code int, label string")
    path = str(tmp_path / "codes")
    writers.save_csv(df, path)
    back = readers.read_csv(spark, path, schema="code int, label string")
    assert sorted(map(tuple, back.collect())) == [(1, 'Say "hi"'), (4, "Divorced, widowed")]
    inferred = readers.read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["code"] == "int"
    raw = readers.read_csv(spark, path, header=False)
    n_files = len([f for f in os.listdir(path) if f.startswith("part-")])
    assert raw.columns == ["_c0", "_c1"] and raw.count() == 2 + n_files  # a header line per file


def test_partitioned_parquet_and_table(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("h"))
    path = str(tmp_path / "p")
    writers.save_parquet(df, path, partition_by=["g", "h"], cluster_by=["g"], num_partitions=2)
    back = readers.read_parquet(spark, path)
    assert back.columns == ["id", "g", "h"] and back.count() == 100
    files = back.groupBy("g", "h").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()
    assert {r.n for r in files} == {1}
    assert "PartitionFilters: [isnotnull(g" in back.filter("g = 1")._jdf.queryExecution().executedPlan().toString()
    writers.save_table(df, "t_roundtrip", partition_by=["g"], path=str(tmp_path / "tbl"))
    assert readers.read_table(spark, "t_roundtrip").count() == 100
    writers.save_table(df.filter("g = 0"), "t_flat", path=str(tmp_path / "flat"))   # unpartitioned
    assert readers.read_table(spark, "t_flat").count() == 34
    writers.drop_tables(spark, ["t_roundtrip", "t_flat"])
    assert not spark.catalog.tableExists("t_roundtrip") and not spark.catalog.tableExists("t_flat")


def _write_csv(spark, rows, path):
    df = spark.createDataFrame(rows, survey.BRONZE_SCHEMA)
    writers.save_csv(df, path, num_partitions=1)


def test_survey_pipeline_edge_rows(spark, survey_rows, tmp_path):
    rows = [
        survey_rows(CASEID=20210000001, NUMMHS=2),
        survey_rows(CASEID=20210000002, AGE=None),
        survey_rows(CASEID=20210000003, AGE=-9, NUMMHS=0),
        survey_rows(CASEID=20210000004, AGE=-1),
        survey_rows(CASEID=20210000005, EDUC=-10),
        survey_rows(CASEID=20210000006, AGE=-1, EDUC=-10),
        survey_rows(CASEID=20210000007, GENDER=7),
        survey_rows(CASEID=20210000008, GENDER=-9, NUMMHS=4),
        survey_rows(CASEID=2021),
        survey_rows(CASEID=20219999999999),
    ]
    csv = str(tmp_path / "raw")
    _write_csv(spark, rows, csv)
    raw = survey.read_raw(spark, csv)
    res = survey.run(spark, raw, str(tmp_path / "layers"))
    bronze = {r.CASEID for r in res["bronze"].frame.collect()}
    assert 20210000002 not in bronze                      # NULL row dropped
    assert {20210000004, 20210000005, 20210000006}.isdisjoint(bronze)  # rules
    assert res["bronze"].failed["non_negative_age"] == 2
    assert res["bronze"].failed["valid_educ_values"] == 2
    assert res["bronze"].rows_in == 9 and res["bronze"].rows_out == 6
    assert res["bronze"].lost == {"rows_read": 10, "null_rows": 1}
    s1 = {r.CASEID: r for r in res["silver_1"].frame.collect()}
    assert s1[20210000007].GENDER_mapped == "Unknown"
    assert s1[20210000008].GENDER_mapped == "Missing/unknown/not collected/invalid"
    assert s1[20210000001].CASEID_int == 1
    assert s1[2021].CASEID_int is None and s1[20219999999999].CASEID_int is None
    s2 = {r.CASEID: r for r in res["silver_2"].frame.collect()}
    assert set(s2) == {20210000001, 20210000003, 20210000007, 20210000008}  # NULL ids dropped
    assert s2[20210000003].NUMMHS_normalized == 0.0 and s2[20210000008].NUMMHS_normalized == 1.0
    gold = res["gold_full"].frame
    assert gold.columns == survey.GOLD_SCHEMA.fieldNames()
    assert [f.dataType.simpleString() for f in gold.schema.fields][-2:] == ["float", "float"]
    splits = res["gold_splits"].frame
    assert splits.count() == 4 and set(splits.columns) == set(survey.GOLD_SPLITS_SCHEMA.fieldNames())
    log = {(r.layer, r.metric): r.value for r in run_log(spark, res).collect()}
    assert log[("bronze", "rows_out")] == 6 and log[("gold_full", "rows_out")] == 4
    assert log[("bronze", "warned:valid_gender")] == 0   # warn-only, rows kept


def test_survey_constant_scaled_column(spark, survey_rows, tmp_path):
    rows = [survey_rows(CASEID=20210000000 + i, NUMMHS=3) for i in range(1, 6)]
    _write_csv(spark, rows, str(tmp_path / "raw"))
    res = survey.run(spark, survey.read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "l"), upto="silver_2")
    got = {(r.NUMMHS_normalized, r.NUMMHS_standardized) for r in res["silver_2"].frame.collect()}
    assert got == {(0.5, 0.0)}


def test_survey_header_only_file(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    (d / "part.csv").write_text(",".join(survey.INT_COLUMNS + [survey.ID_COLUMN]) + "\n")
    res = survey.run(spark, survey.read_raw(spark, str(d)), str(tmp_path / "l"))
    assert all(r.frame.count() == 0 for r in res.values())
    assert all(r.rows_out == 0 for r in res.values())


def test_survey_stream_matches_batch(spark, survey_rows, tmp_path):
    from strata_engine.streaming import row_local_layer, survey_stream

    src = tmp_path / "incoming"
    rows1 = [survey_rows(CASEID=20210000000 + i, AGE=(i % 5) - 2) for i in range(1, 40)]
    rows2 = [survey_rows(CASEID=20210001000 + i, GENDER=i % 4) for i in range(1, 40)]
    _write_csv(spark, rows1, str(src / "a"))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = survey_stream(spark, str(src / "*"), out, checkpoint=ckpt)
    q.awaitTermination(120)
    n1 = spark.read.parquet(out).count()
    _write_csv(spark, rows2, str(src / "b"))
    q = survey_stream(spark, str(src / "*"), out, checkpoint=ckpt)   # restart: only new files
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = row_local_layer(spark.createDataFrame(rows1 + rows2, survey.BRONZE_SCHEMA), survey.BRONZE_RULES,
                            survey.CODE_LISTS, survey.ID_COLUMN, [survey.ID_COLUMN])
    cols = batch.columns
    got = sorted(tuple(r) for r in streamed.select(*cols).collect())
    want = sorted(tuple(r) for r in batch.collect())
    assert n1 < len(got) and got == want
    assert os.path.isdir(ckpt)


def test_warn_rules_keep_rows(spark, tmp_path):
    from strata_engine.plans.layers import Layer, run_pipeline

    src = spark.createDataFrame([(1, "a"), (2, None), (-1, "c")], "x int, y string")
    layer = Layer("only", lambda i: i["src"], {"pos": "x > 0"}, warn_rules={"y_present": "y IS NOT NULL"})
    res = run_pipeline(spark, [layer], str(tmp_path), sources={"src": src})["only"]
    assert sorted(r.x for r in res.frame.collect()) == [1, 2]
    assert res.failed == {"pos": 1} and res.warned == {"y_present": 1}
    assert (res.rows_in, res.rows_out) == (3, 2)


def test_layer_decorator_chain(spark, tmp_path):
    from strata_engine.plans.layers import layer, run_pipeline

    @layer("first", rules={"pos": "x > 0"}, partition_by=["g"])
    def first(inputs):
        return inputs["src"].withColumn("g", F.col("x") % 2)

    @layer("second", warn_rules={"small": "x < 3"})
    def second(inputs):
        return inputs["first"].withColumn("y", F.col("x") * 10)

    src = spark.createDataFrame([(1,), (2,), (3,), (-4,)], "x int")
    res = run_pipeline(spark, [first, second], str(tmp_path), sources={"src": src})
    assert sorted((r.x, r.y) for r in res["second"].frame.collect()) == [(1, 10), (2, 20), (3, 30)]
    assert res["first"].failed == {"pos": 1} and res["second"].warned == {"small": 1}


def test_cli_runs_survey_plan(spark, survey_rows, tmp_path, capsys):
    from strata_engine.__main__ import main

    rows = [survey_rows(CASEID=20210000000 + i, NUMMHS=i % 4, GENDER=1 + i % 2) for i in range(1, 30)]
    _write_csv(spark, rows, str(tmp_path / "raw"))
    res = main([str(tmp_path / "raw"), str(tmp_path / "out")])
    assert res["gold_splits"].frame.count() == 29
    assert os.path.isdir(str(tmp_path / "out" / "gold_full"))
    assert "rows_out" in capsys.readouterr().out


def test_csv_columns_by_header_name(spark, survey_rows, tmp_path):
    import pytest

    rows = [survey_rows(CASEID=20210000001, GENDER=1, RACE=5), survey_rows(CASEID=20210000002, GENDER=2, RACE=3)]
    df = spark.createDataFrame(rows, survey.BRONZE_SCHEMA)
    swapped = [c for c in df.columns if c not in ("GENDER", "RACE")] + ["RACE", "GENDER"]
    bad = df.select(*swapped).withColumn("AGE", F.when(F.col("CASEID") == 20210000002, F.lit("old")).otherwise("5"))
    writers.save_csv(bad, str(tmp_path / "swapped"), num_partitions=1)
    got = survey.read_raw(spark, str(tmp_path / "swapped")).collect()
    assert sorted((r.GENDER, r.RACE, r.AGE, r[readers.BAD_VALUES]) for r in got) == [(1, 5, 5, []), (2, 3, None, ["AGE"])]
    res = survey.run(spark, survey.read_raw(spark, str(tmp_path / "swapped")), str(tmp_path / "l"), upto="bronze")["bronze"]
    assert res.lost == {"rows_read": 2, "null_rows": 1, "bad:AGE": 1} and res.rows_out == 1
    with pytest.raises(readers.HeaderMismatch):
        readers.read_csv_by_name(spark, str(tmp_path / "swapped"), survey.SILVER_1_SCHEMA)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path / "swapped"), schema=survey.BRONZE_SCHEMA).collect()


def test_layer_with_a_wrong_type_stops(spark, tmp_path):
    import pytest

    from strata_engine.operators.schema import SchemaMismatch
    from strata_engine.plans import orders

    src = spark.createDataFrame([(1, 2, "F", "9.5", None, "1-URGENT")],
                                "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice string, "
                                "o_orderdate timestamp_ntz, o_orderpriority string")
    with pytest.raises(SchemaMismatch):
        orders.run(spark, src, str(tmp_path / "l"))
    assert all(layer.schema for layer in orders.layers()) and all(layer.schema for layer in survey.layers())


def test_survey_layout_and_pruning(spark, survey_rows, tmp_path):
    rows = [survey_rows(CASEID=20210000000 + i, GENDER=1 + i % 2, NUMMHS=i % 4) for i in range(1, 60)]
    _write_csv(spark, rows, str(tmp_path / "raw"))
    res = survey.run(spark, survey.read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "l"))
    assert sum(layer.cluster for layer in survey.layers()) == 1  # one full shuffle in the plan
    for name in ("silver_3", "gold_full", "gold_splits"):
        plan = res[name].frame.where("GENDER = 1")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(GENDER" in plan, name
    assert os.path.isdir(str(tmp_path / "l" / "gold_splits" / "split=train" / "GENDER=1"))


def test_stream_needs_a_checkpoint(spark, tmp_path):
    import pytest

    from strata_engine.streaming.incremental import start_file_sink

    stream = spark.readStream.schema("x int").csv(str(tmp_path))
    with pytest.raises(ValueError):
        start_file_sink(stream, str(tmp_path / "out"), "")


def test_layers_run_with_small_methods_and_unsorted_saves(spark, tmp_path):
    """Wide plans: generated methods stay short enough to be compiled, saves
    need no sort, and the session is as before afterwards."""
    from strata_engine.plans.layers import Layer, run_layer
    from strata_engine.session import WIDE_CONF

    seen = []

    def build(inputs):
        seen.append({k: spark.conf.get(k, None) for k in WIDE_CONF})
        return inputs["raw"]

    raw = spark.createDataFrame([(i % 100, None if i == 7 else i) for i in range(500)], "a int, b int")
    run = lambda name: run_layer(spark, Layer(name, build, {"ok": "b % 5 != 0"}, partition_by=["a"], cluster=False), {"raw": raw}, str(tmp_path))
    before = {k: spark.conf.get(k, None) for k in WIDE_CONF}
    result = run("x")
    assert seen == [{k: str(v) for k, v in WIDE_CONF.items()}]
    assert {k: spark.conf.get(k, None) for k in WIDE_CONF} == before
    # more partitions in a task than files it may hold open: the rest is sorted, no row is lost
    assert (result.rows_in, result.rows_out, result.failed) == (500, 399, {"ok": 101})
    assert sorted(map(tuple, result.frame.collect())) == sorted((i % 100, i) for i in range(500) if i % 5 and i != 7)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
    try:
        run("y")
        assert seen[1]["spark.sql.codegen.hugeMethodLimit"] == "9000"
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
