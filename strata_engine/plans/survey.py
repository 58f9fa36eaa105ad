"""The bronze → silver → gold plan for the 40-column health-survey extract
(one row per case, integer codes, ``-9`` = missing), as layers.

Differences from a literal reading of the original pipeline, on purpose:
rules drop rows BEFORE the single save; code labels and scaling are native
expressions; the split is stratified and reproducible and is a ``split``
column (one table per layer, partitioned by split) instead of separately
written frames; schema contracts compare names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from strata_engine.functions import rules as R
from strata_engine.operators.clean import drop_columns, drop_null_rows
from strata_engine.operators.scale import min_max_z
from strata_engine.operators.split import stratified_split
from strata_engine.operators.strata import add_strata, frequency_index, value_counts
from strata_engine.operators.transform import id_suffix, map_codes
from strata_engine.plans.layers import Layer, LayerResult, run_pipeline
from strata_engine.sources.readers import BAD_VALUES, read_csv, read_csv_by_name

# ---------------------------------------------------------------------------
# Fixed values (must equal the survey's codebook and layout for right results)
# ---------------------------------------------------------------------------
INT_COLUMNS = [
    "YEAR", "AGE", "EDUC", "ETHNIC", "RACE", "GENDER",
    "SPHSERVICE", "CMPSERVICE", "OPISERVICE", "RTCSERVICE", "IJSSERVICE",
    "MH1", "MH2", "MH3", "SUB", "MARSTAT", "SMISED", "SAP", "EMPLOY", "DETNLF",
    "VETERAN", "LIVARAG", "NUMMHS",
    "TRAUSTREFLG", "ANXIETYFLG", "ADHDFLG", "CONDUCTFLG", "DELIRDEMFLG", "BIPOLARFLG",
    "DEPRESSFLG", "ODDFLG", "PDDFLG", "PERSONFLG", "SCHIZOFLG", "ALCSUBFLG", "OTHERDISFLG",
    "STATEFIP", "DIVISION", "REGION",
]
ID_COLUMN = "CASEID"
PARTITION_COLUMNS = ["GENDER", "RACE", "ETHNIC", "MARSTAT", "EMPLOY"]
SCALED_COLUMNS = ["NUMMHS"]
MISSING = "Missing/unknown/not collected/invalid"
CODE_LISTS = {
    "GENDER": {1: "Male", 2: "Female", -9: MISSING},
    "RACE": {
        1: "American Indian/Alaska Native",
        2: "Asian",
        3: "Black or African American",
        4: "Native Hawaiian or Other Pacific Islander",
        5: "White",
        6: "Some other race alone/two or more races",
        -9: MISSING,
    },
    "MARSTAT": {1: "Never married", 2: "Now married", 3: "Separated", 4: "Divorced, widowed", -9: MISSING},
    "EMPLOY": {
        1: "Full-time",
        2: "Part-time",
        3: "Employed full-time/part-time not differentiated",
        4: "Unemployed",
        5: "Not in labor force",
        -9: MISSING,
    },
    "ETHNIC": {
        1: "Mexican",
        2: "Puerto Rican",
        3: "Other Hispanic or Latino origin",
        4: "Not of Hispanic or Latino origin",
        -9: MISSING,
    },
}
# Names of the lower-bound rules that do not follow from the column name.
RULE_NAMES = {
    "TRAUSTREFLG": "valid_traustref_values",
    "ANXIETYFLG": "valid_anxiety_values",
    "ADHDFLG": "valid_adhd_values",
    "CONDUCTFLG": "valid_conduct_values",
    "DELIRDEMFLG": "valid_delirdem_values",
    "BIPOLARFLG": "valid_bipolar_values",
    "DEPRESSFLG": "valid_depress_values",
    "ODDFLG": "valid_odd_values",
    "PDDFLG": "valid_pdd_values",
    "PERSONFLG": "valid_person_values",
    "SCHIZOFLG": "valid_schizo_values",
    "ALCSUBFLG": "valid_alcsub_values",
    "OTHERDISFLG": "valid_otherdis_values",
}
UNKNOWN_LABEL = "Unknown"
SEED = 42
SPLIT_WEIGHTS = (0.6, 0.2, 0.2)
# ---------------------------------------------------------------------------

MAPPED_COLUMNS = [f"{c}_mapped" for c in CODE_LISTS]
SCALED_OUT = [f"{c}_normalized" for c in SCALED_COLUMNS] + [f"{c}_standardized" for c in SCALED_COLUMNS]
STRATA_COL, INDEX_COL, SPLIT_COL = "demographic_strata", "strataIndex", "split"


def _struct(fields: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


BRONZE_SCHEMA = _struct([(c, IntegerType()) for c in INT_COLUMNS] + [(ID_COLUMN, LongType())])
SILVER_1_SCHEMA = _struct(
    [(f.name, f.dataType) for f in BRONZE_SCHEMA.fields]
    + [(c, StringType()) for c in MAPPED_COLUMNS]
    + [(f"{ID_COLUMN}_int", IntegerType())]
)
SILVER_2_SCHEMA = _struct([(f.name, f.dataType) for f in SILVER_1_SCHEMA.fields] + [(c, FloatType()) for c in SCALED_OUT])
SILVER_3_SCHEMA = _struct(
    [(f.name, f.dataType) for f in SILVER_2_SCHEMA.fields]
    + [(STRATA_COL, StringType()), (INDEX_COL, DoubleType()), (SPLIT_COL, StringType())]
)
GOLD_SCHEMA = SILVER_2_SCHEMA
GOLD_SPLITS_SCHEMA = _struct([(f.name, f.dataType) for f in GOLD_SCHEMA.fields] + [(SPLIT_COL, StringType())])

BOUNDED_COLUMNS = [c for c in INT_COLUMNS if c not in ("YEAR", "AGE")]

BASE_RULES = {
    **R.in_range_or("AGE", 0, -9, name="non_negative_age"),
    **R.lossless_cast("AGE", "INT", name="valid_age_type"),
    **R.lossless_cast("YEAR", "INT", name="valid_year_type"),
    **R.lossless_cast(ID_COLUMN, "BIGINT", name="valid_caseid_type"),
    **R.at_least(BOUNDED_COLUMNS, -9, RULE_NAMES),
}
BRONZE_RULES = dict(BASE_RULES)
SILVER_1_RULES = dict(BASE_RULES)
SILVER_2_RULES = {**BASE_RULES, **R.not_null(SCALED_OUT)}
SILVER_3_RULES = {
    **BASE_RULES,
    **R.not_blank(STRATA_COL, name="valid_demographic_strata"),
    "valid_strataIndex": f"{INDEX_COL} IS NOT NULL AND try_cast({INDEX_COL} AS DOUBLE) = {INDEX_COL}",
}
GOLD_RULES = {
    **BASE_RULES,
    **R.not_null(SCALED_OUT),
    **R.not_null(MAPPED_COLUMNS),
    **R.lossless_cast(f"{ID_COLUMN}_int", "INT", name="valid_caseid_int"),
}
# Warn-only checks of the partition columns (reported, rows kept).
PARTITION_NOT_NULL = R.not_null(PARTITION_COLUMNS)


def _bronze(inputs):
    return inputs["raw"]


def _silver_1(inputs):
    df = map_codes(inputs["bronze"], CODE_LISTS, default=UNKNOWN_LABEL)
    return id_suffix(df, ID_COLUMN, f"{ID_COLUMN}_int", start=5, length=10)


def _silver_2(inputs):
    return min_max_z(inputs["silver_1"], SCALED_COLUMNS, out_type="float")


def _silver_3(inputs):
    df = add_strata(inputs["silver_2"], PARTITION_COLUMNS, STRATA_COL)
    counts = value_counts(df, STRATA_COL)
    df = frequency_index(df, STRATA_COL, INDEX_COL, counts=counts)
    return stratified_split(df, STRATA_COL, [ID_COLUMN], SPLIT_WEIGHTS, seed=SEED, out=SPLIT_COL)


def _gold_full(inputs):
    return drop_columns(drop_null_rows(inputs["silver_3"]), [STRATA_COL, INDEX_COL, SPLIT_COL])


def _gold_splits(inputs):
    return drop_columns(drop_null_rows(inputs["silver_3"]), [STRATA_COL, INDEX_COL])


def layers() -> list[Layer]:
    return [
        # one shuffle lays the table out by the five columns; every later
        # layer reads files that are laid out so already
        Layer("bronze", _bronze, BRONZE_RULES, BRONZE_SCHEMA, PARTITION_COLUMNS, warn_rules=PARTITION_NOT_NULL, drop_nulls=True),
        Layer("silver_1", _silver_1, SILVER_1_RULES, SILVER_1_SCHEMA, PARTITION_COLUMNS, cluster=False),
        Layer("silver_2", _silver_2, SILVER_2_RULES, SILVER_2_SCHEMA, PARTITION_COLUMNS, cluster=False, drop_nulls=True),
        Layer("silver_3", _silver_3, SILVER_3_RULES, SILVER_3_SCHEMA, [*PARTITION_COLUMNS, SPLIT_COL], cluster=False),
        Layer("gold_full", _gold_full, GOLD_RULES, GOLD_SCHEMA, PARTITION_COLUMNS, cluster=False),
        Layer("gold_splits", _gold_splits, GOLD_RULES, GOLD_SPLITS_SCHEMA, [SPLIT_COL, *PARTITION_COLUMNS], cluster=False),
    ]


def read_raw(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """The survey CSV (a file, directory or glob) with a header line. Columns
    are taken by their header names; a value that does not parse becomes NULL
    and its column is named in ``BAD_VALUES`` (counted in the run log)."""
    if infer_schema:
        return read_csv(spark, path, header=True, infer_schema=True)
    return read_csv_by_name(spark, path, BRONZE_SCHEMA, bad_values=BAD_VALUES)


def run(spark: SparkSession, raw: DataFrame, root: str, upto: str | None = None) -> dict[str, LayerResult]:
    return run_pipeline(spark, layers(), root, sources={"raw": raw}, upto=upto)
