import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from strata_engine.operators import quality, schema
from strata_engine.plans import survey


def test_enforce_drop_edge_rows(spark, survey_rows):
    rows = [
        survey_rows(),                      # valid
        survey_rows(AGE=-9, CASEID=20210000002),   # sentinel kept
        survey_rows(AGE=-1, CASEID=20210000003),   # non_negative_age
        survey_rows(EDUC=-10, CASEID=20210000004),  # valid_educ_values
        survey_rows(AGE=-1, EDUC=-10, CASEID=20210000005),  # both: dropped once
    ]
    df = spark.createDataFrame(rows, survey.BRONZE_SCHEMA)
    kept = quality.enforce(df, survey.BRONZE_RULES)
    assert sorted(r.CASEID for r in kept.collect()) == [20210000001, 20210000002]
    rep = {r.rule: r for r in quality.report(df, survey.BRONZE_RULES).collect()}
    assert rep["non_negative_age"].n_failed == 2
    assert rep["valid_educ_values"].n_failed == 2
    assert all(r.n_passed + r.n_failed == r.n_total == 5 for r in rep.values())
    assert len(rep) == 41


def test_enforce_output_has_no_violations(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7 - 3).alias("v"))
    rules = {"pos": "v >= 0", "odd_id": "id % 2 = 1"}
    kept = quality.enforce(df, rules)
    assert all(r.n_failed == 0 for r in quality.report(kept, rules).collect())


def test_null_counts_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rules = {"pos": "x > 0"}
    assert quality.enforce(df, rules).count() == 1
    flagged = {r.x: r.failed_rules for r in quality.flag(df, rules).collect()}
    assert flagged == {1: [], None: ["pos"]}
    assert quality.report(df, rules).first().n_failed == 1


def test_enforce_fail_raises(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    with pytest.raises(quality.RuleViolation):
        quality.enforce(df, {"pos": "x > 0"}, "fail")


def test_rules_push_down_to_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("v", F.col("id") * 2).write.parquet(path)
    plan = quality.enforce(spark.read.parquet(path), {"v_min": "v >= 10"})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v), GreaterThanOrEqual(v,10)]" in plan


def test_proportions_and_drift(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "c string")
    p = {r.value: (r.n, r.share) for r in quality.proportions(df, "c").collect()}
    assert p == {"a": (3, 0.6), "b": (1, 0.2), None: (1, 0.2)}
    d = {r.value: r for r in quality.proportions(df, "c", {"a": 0.5, "z": 0.1}, tolerance=0.15).collect()}
    assert d["a"].within_tolerance is True and d["a"].expected_share == 0.5
    assert d["z"].n == 0 and d["z"].share == 0.0 and d["z"].within_tolerance is True
    assert d["b"].expected_share is None and d["b"].within_tolerance is False


def test_schema_check_modes(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    exp = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    assert schema.matches(df, exp)
    schema.check(df, exp)
    bad = StructType([StructField("a", LongType()), StructField("c", StringType())])
    with pytest.raises(schema.SchemaMismatch):
        schema.check(df, bad)
    rows = {r.column_name: r.status for r in schema.diff(df, bad).collect()}
    assert rows == {"a": "type_mismatch", "c": "missing", "b": "unexpected"}
    summ = [(r.column_name, r.data_type) for r in schema.summary(df).orderBy("position").collect()]
    assert summ == [("a", "int"), ("b", "string")]
