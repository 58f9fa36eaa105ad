"""The survey plan at its full width, on a 40-column stand-in made from
``orders``, against SQL written out by hand.

The stand-in only gives rows in the survey's schema (as CSV, the form the
plan reads): every column is a small formula over the order's and the
customer's key, with NULLs, sentinels, codes outside the lists, and values
that rules turn away. The plan, its rules and its layers are the library's.
"""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from strata_engine.functions.numeric import round_half_away
from strata_engine.plans import survey as S
from strata_engine.plans.layers import LayerResult, run_log
from strata_engine.plans.publish import source_identity
from strata_engine.plans.queries import query, table
from strata_engine.session import scratch_path, wide_plan
from strata_engine.sources import writers

COLUMNS = [*S.INT_COLUMNS, S.ID_COLUMN]
_CODES = {
    "GENDER": "CASE o_custkey % 12 WHEN 0 THEN -9 WHEN 1 THEN 3 ELSE o_custkey % 2 + 1 END",
    "RACE": "CASE o_custkey % 12 WHEN 3 THEN -9 ELSE o_custkey % 6 + 1 END",
    "MARSTAT": "CASE o_custkey % 12 WHEN 5 THEN 8 ELSE o_custkey % 4 + 1 END",
    "EMPLOY": "CASE o_custkey % 12 WHEN 6 THEN -9 ELSE o_custkey % 3 + 2 END",
    "ETHNIC": "CASE o_custkey % 12 WHEN 7 THEN -9 ELSE o_custkey % 4 + 1 END",
    "YEAR": "2000 + o_orderkey % 23",
    "AGE": "CASE o_orderkey % 40 WHEN 0 THEN -9 WHEN 7 THEN -3 ELSE o_orderkey % 14 + 1 END",
    "NUMMHS": "CASE o_orderkey % 29 WHEN 0 THEN -9 ELSE o_orderkey % 4 END",
}


def _formula(i: int, column: str) -> str:
    """SQL that Spark and DuckDB read alike."""
    usual = _CODES.get(column, f"(o_orderkey + {i} * o_custkey) % {i % 7 + 2}")
    low = f"WHEN (o_orderkey * 11 + {31 * i}) % 499 = 0 THEN -10 " if column in S.BOUNDED_COLUMNS else ""
    return f"CAST(CASE WHEN (o_orderkey * 7 + {i}) % 997 = 0 THEN NULL {low}ELSE {usual} END AS INT) AS {column}"


FORMULAS = [_formula(i, c) for i, c in enumerate(S.INT_COLUMNS)] + [f"CAST(20210000000 + o_orderkey AS BIGINT) AS {S.ID_COLUMN}"]

_RUNS: dict[tuple[str, str, str], dict[str, LayerResult]] = {}
_LOCK = threading.Lock()


def survey_run(spark, sf) -> dict[str, LayerResult]:
    """The plan over the stand-in, once per session, path and state of its files."""
    orders = table(spark, sf, "orders")
    key = (spark.sparkContext.applicationId, sf, source_identity(orders))
    with _LOCK:
        if key not in _RUNS:
            extract = scratch_path(spark, "survey_csv")
            with wide_plan(spark):
                writers.save_csv(orders.selectExpr(*FORMULAS), extract)
            _RUNS[key] = S.run(spark, S.read_raw(spark, extract), scratch_path(spark, "survey_layers"))
        return _RUNS[key]


# ---------------------------------------------------------------------------
# The same plan as SQL, rules written out, not taken from the rule builders.
# ---------------------------------------------------------------------------

_BASE = {
    "non_negative_age": "AGE >= 0 OR AGE = -9",
    "valid_age_type": "TRY_CAST(AGE AS INTEGER) = AGE",
    "valid_year_type": "TRY_CAST(YEAR AS INTEGER) = YEAR",
    "valid_caseid_type": "TRY_CAST(CASEID AS BIGINT) = CASEID",
    **{S.RULE_NAMES.get(c, f"valid_{c.lower()}_values"): f"{c} >= -9" for c in S.INT_COLUMNS if c not in ("YEAR", "AGE")},
}
_SCALED = {"valid_nummhs_normalized": "NUMMHS_normalized IS NOT NULL", "valid_nummhs_standardized": "NUMMHS_standardized IS NOT NULL"}
_GOLD = {
    **_BASE, **_SCALED,
    "valid_gender_mapped": "GENDER_mapped IS NOT NULL", "valid_race_mapped": "RACE_mapped IS NOT NULL",
    "valid_marstat_mapped": "MARSTAT_mapped IS NOT NULL", "valid_employ_mapped": "EMPLOY_mapped IS NOT NULL",
    "valid_ethnic_mapped": "ETHNIC_mapped IS NOT NULL", "valid_caseid_int": "TRY_CAST(CASEID_int AS INTEGER) = CASEID_int",
}
RULES_SQL = {
    "bronze": _BASE,
    "silver_1": _BASE,
    "silver_2": {**_BASE, **_SCALED},
    "silver_3": {
        **_BASE,
        "valid_demographic_strata": "demographic_strata IS NOT NULL AND demographic_strata <> ''",
        "valid_strataIndex": "strataIndex IS NOT NULL AND TRY_CAST(strataIndex AS DOUBLE) = strataIndex",
    },
    "gold_full": _GOLD,
    "gold_splits": _GOLD,
}
_LABELS = ", ".join(
    f"CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.items()) + f" ELSE 'Unknown' END AS {c}_mapped"
    for c, codes in S.CODE_LISTS.items()
)
_STRATA = "concat_ws('_', GENDER, RACE, ETHNIC, MARSTAT, EMPLOY)"
_ALL = ", ".join(COLUMNS)
_TYPED = ", ".join([_ALL, *(f"{c}_mapped" for c in S.CODE_LISTS), "CASEID_int"])
_WIDE = f"{_TYPED}, NUMMHS_normalized, NUMMHS_standardized"
_BUILT = {
    "bronze": f"SELECT * FROM raw WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLUMNS)}",
    "silver_1": f"SELECT {_ALL}, {_LABELS}, TRY_CAST(substr(CASEID::VARCHAR, 5, 10) AS INTEGER) AS CASEID_int FROM bronze",
    "silver_2": (
        f"SELECT {_TYPED}, n::FLOAT AS NUMMHS_normalized, ((n - avg(n) OVER ()) / stddev_samp(n) OVER ())::FLOAT AS NUMMHS_standardized "
        "FROM (SELECT s.*, (NUMMHS - mn)::DOUBLE / (mx - mn) AS n FROM silver_1 s, "
        "(SELECT min(NUMMHS) AS mn, max(NUMMHS) AS mx FROM silver_1))"
    ),
    "silver_3": (
        f"SELECT {_WIDE}, demographic_strata, strataIndex, CASE WHEN rn <= floor(0.6::DOUBLE * n + 0.5::DOUBLE) THEN 'train' "
        "WHEN rn <= floor(0.8::DOUBLE * n + 0.5::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ("
        "SELECT s.*, (dense_rank() OVER (ORDER BY n DESC, demographic_strata) - 1)::DOUBLE AS strataIndex FROM ("
        f"SELECT *, {_STRATA} AS demographic_strata, count(*) OVER (PARTITION BY {_STRATA}) AS n, "
        f"row_number() OVER (PARTITION BY {_STRATA} ORDER BY md5(concat_ws('-', '42', CASEID::VARCHAR)), CASEID) AS rn FROM silver_2) s)"
    ),
    "gold_full": f"SELECT {_WIDE} FROM silver_3",
    "gold_splits": f"SELECT {_WIDE}, split FROM silver_3",
}


def _chain() -> str:
    ctes = [f"raw AS (SELECT {', '.join(FORMULAS)} FROM orders)"]
    for name, sql in _BUILT.items():
        rules = " AND ".join(f"({r})" for r in RULES_SQL[name].values())
        ctes += [f"{name}__built AS ({sql})", f"{name} AS (SELECT * FROM {name}__built WHERE {rules})"]
    return "WITH " + ",\n".join(ctes) + "\n"


def _gold_sql(name: str, extra: str = "") -> str:
    scaled = ", ".join(f"round({c}::DOUBLE, 4) AS {c}" for c in S.SCALED_OUT)
    return f"{_chain()}SELECT {_TYPED}, {scaled}{extra} FROM {name}"


def _gold(spark, sf, name, columns):
    frame = survey_run(spark, sf)[name].frame
    # 32-bit values: four places are what both engines agree on
    return frame.withColumns({c: round_half_away(F.col(c).cast("double"), 4) for c in S.SCALED_OUT}).select(*columns)


@query("survey_gold_full", _gold_sql("gold_full"))
def survey_gold_full(spark, sf):
    """All 48 columns of the last layer after 41, 41, 43, 43 and 49 rules."""
    return _gold(spark, sf, "gold_full", S.GOLD_SCHEMA.fieldNames())


@query("survey_gold_splits", _gold_sql("gold_splits", ", split"))
def survey_gold_splits(spark, sf):
    """The same with the stratified split of every case."""
    return _gold(spark, sf, "gold_splits", S.GOLD_SPLITS_SCHEMA.fieldNames())


def _log_sql() -> str:
    parts = [
        "SELECT 'bronze' AS layer, 'rows_read' AS metric, count(*) AS value FROM raw",
        "SELECT 'bronze', 'null_rows', (SELECT count(*) FROM raw) - count(*) FROM bronze__built",
        "SELECT 'silver_2', 'rows_read', count(*) FROM silver_1",
        "SELECT 'silver_2', 'null_rows', 0::BIGINT",
    ]
    parts += [f"SELECT 'bronze', 'warned:valid_{c.lower()}', count(*) FILTER ({c} IS NULL) FROM bronze__built" for c in S.PARTITION_COLUMNS]
    for name, rules in RULES_SQL.items():
        parts += [f"SELECT '{name}', 'rows_in', count(*) FROM {name}__built", f"SELECT '{name}', 'rows_out', count(*) FROM {name}"]
        parts += [
            f"SELECT '{name}', 'failed:{n}', count(*) FILTER (WHERE NOT coalesce(({r}), false)) FROM {name}__built" for n, r in rules.items()
        ]
    return _chain() + " UNION ALL ".join(parts)


@query("survey_run_log", _log_sql())
def survey_run_log(spark, sf):
    """Rows in and out and failures of every rule of every layer."""
    return run_log(spark, survey_run(spark, sf))
