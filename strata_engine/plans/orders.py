"""The layer plan run on the ``orders`` table (the stand-in for the survey
extract in the registered queries): a code column from the leading digit of
the priority, an identifier ``20210000000 + o_orderkey``, the scaled column
``o_totalprice``, and strata = status × priority.

``oracle_chain()`` is the same plan as one SQL CTE chain, used as the
independent check of every layer query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata_engine.functions import rules as R
from strata_engine.operators.clean import drop_columns, drop_null_rows
from strata_engine.operators.scale import min_max_z
from strata_engine.operators.split import stratified_split
from strata_engine.operators.strata import add_strata, frequency_index, value_counts
from strata_engine.operators.transform import id_suffix, map_codes
from strata_engine.plans.layers import Layer, LayerResult, run_pipeline

# Fixed values of the stand-in plan.
PRIORITY_LABELS = {
    1: "Urgent",
    2: "High",
    3: "Medium",
    4: "Not specified",
    5: "Low",
    -9: "No answer",
}
ID_BASE = 20210000000
PRICE_FLOOR = 1500
SEED = 42
WEIGHTS = (0.6, 0.2, 0.2)

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
BRONZE_COLS = ORDER_COLS + ["prio_code", "caseid"]
TYPED_COLS = BRONZE_COLS + ["prio_mapped", "caseid_int"]
SCALED = ["o_totalprice_normalized", "o_totalprice_standardized"]
SCALED_COLS = TYPED_COLS + SCALED
SPLIT_COLS = SCALED_COLS + ["strata", "strata_index", "split"]
GOLD_COLS = SCALED_COLS
GOLD_SPLIT_COLS = SCALED_COLS + ["split"]

TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "prio_code": "int", "caseid": "bigint",
    "prio_mapped": "string", "caseid_int": "int", "o_totalprice_normalized": "double",
    "o_totalprice_standardized": "double", "strata": "string", "strata_index": "double", "split": "string",
}


def schema_of(cols: list[str]) -> str:
    """The declared schema of a layer, as DDL text."""
    return ", ".join(f"{c} {TYPES[c]}" for c in cols)


BASE_RULES = {
    **R.in_range_or("o_totalprice", 0, -9, name="non_negative_price"),
    **R.lossless_cast("o_custkey", "INT", name="valid_custkey_type"),
    **R.lossless_cast("caseid", "BIGINT", name="valid_caseid_type"),
    **R.at_least(["prio_code", "o_custkey"], -9),
    "price_floor": f"o_totalprice >= {PRICE_FLOOR}",
}
SCALED_RULES = {**BASE_RULES, **R.not_null(SCALED)}
SPLIT_RULES = {
    **SCALED_RULES,
    **R.not_blank("strata", name="valid_strata"),
    "valid_strata_index": "strata_index IS NOT NULL AND try_cast(strata_index AS DOUBLE) = strata_index",
}
GOLD_RULES = {
    **SCALED_RULES,
    **R.not_null(["prio_mapped"]),
    **R.lossless_cast("caseid_int", "INT", name="valid_caseid_int"),
}
LAYER_RULES = {
    "bronze": BASE_RULES,
    "silver_typed": BASE_RULES,
    "silver_scaled": SCALED_RULES,
    "silver_split": SPLIT_RULES,
    "gold_full": GOLD_RULES,
    "gold_splits": GOLD_RULES,
}
LAYER_NAMES = list(LAYER_RULES)
# Layers that drop rows with a NULL, and the table they read.
NULLS_DROPPED_FROM = {"bronze": "orders", "silver_scaled": "silver_typed"}


def _bronze(inputs):
    o = inputs["orders"]
    df = o.select(
        *ORDER_COLS,
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prio_code"),
        (F.lit(ID_BASE) + F.col("o_orderkey")).alias("caseid"),
    )
    return df


def _silver_typed(inputs):
    df = map_codes(inputs["bronze"], {"prio_code": PRIORITY_LABELS}, default="Unknown")
    df = df.withColumnRenamed("prio_code_mapped", "prio_mapped")
    return id_suffix(df, "caseid", "caseid_int", start=5, length=10)


def _silver_scaled(inputs):
    return min_max_z(inputs["silver_typed"], ["o_totalprice"])


def _silver_split(inputs):
    df = add_strata(inputs["silver_scaled"], ["o_orderstatus", "o_orderpriority"], "strata")
    counts = value_counts(df, "strata")
    df = frequency_index(df, "strata", "strata_index", counts=counts)
    return stratified_split(df, "strata", ["o_orderkey"], WEIGHTS, seed=SEED, out="split")


def _gold_full(inputs):
    return drop_columns(drop_null_rows(inputs["silver_split"]), ["strata", "strata_index", "split"])


def _gold_splits(inputs):
    return drop_columns(drop_null_rows(inputs["silver_split"]), ["strata", "strata_index"])


def layers() -> list[Layer]:
    return [
        # one 3-valued partition column each: no clustering shuffle needed
        Layer("bronze", _bronze, BASE_RULES, schema_of(BRONZE_COLS), ["o_orderstatus"], cluster=False, drop_nulls=True),
        Layer("silver_typed", _silver_typed, BASE_RULES, schema_of(TYPED_COLS), ["o_orderstatus"], cluster=False),
        Layer("silver_scaled", _silver_scaled, SCALED_RULES, schema_of(SCALED_COLS), ["o_orderstatus"], cluster=False, drop_nulls=True),
        Layer("silver_split", _silver_split, SPLIT_RULES, schema_of(SPLIT_COLS), ["o_orderstatus", "split"], cluster=False),
        Layer("gold_full", _gold_full, GOLD_RULES, schema_of(GOLD_COLS), ["o_orderstatus"], cluster=False),
        Layer("gold_splits", _gold_splits, GOLD_RULES, schema_of(GOLD_SPLIT_COLS), ["split", "o_orderstatus"], cluster=False),
    ]


def run(spark: SparkSession, orders: DataFrame, root: str, upto: str | None = None) -> dict[str, LayerResult]:
    return run_pipeline(spark, layers(), root, sources={"orders": orders}, upto=upto)


# ---------------------------------------------------------------------------
# The same plan as SQL (DuckDB dialect), for the oracle.
# ---------------------------------------------------------------------------

# The rules written out by hand, not taken from the rule builders: an error
# in a builder shows as a difference.
_ORACLE_BASE = {
    "non_negative_price": "o_totalprice >= 0 OR o_totalprice = -9",
    "valid_custkey_type": "o_custkey BETWEEN -2147483648 AND 2147483647",
    "valid_caseid_type": "caseid IS NOT NULL",
    "valid_prio_code_values": "prio_code >= -9",
    "valid_o_custkey_values": "o_custkey >= -9",
    "price_floor": "o_totalprice >= 1500",
}
_ORACLE_SCALED = {
    **_ORACLE_BASE,
    "valid_o_totalprice_normalized": "o_totalprice_normalized IS NOT NULL",
    "valid_o_totalprice_standardized": "o_totalprice_standardized IS NOT NULL",
}
_ORACLE_GOLD = {
    **_ORACLE_SCALED,
    "valid_prio_mapped": "prio_mapped IS NOT NULL",
    "valid_caseid_int": "caseid_int IS NOT NULL",
}
ORACLE_RULES = {
    "bronze": _ORACLE_BASE,
    "silver_typed": _ORACLE_BASE,
    "silver_scaled": _ORACLE_SCALED,
    "silver_split": {
        **_ORACLE_SCALED,
        "valid_strata": "strata IS NOT NULL AND strata <> ''",
        "valid_strata_index": "strata_index IS NOT NULL",
    },
    "gold_full": _ORACLE_GOLD,
    "gold_splits": _ORACLE_GOLD,
}


def _sql_rules(rules: dict[str, str]) -> str:
    return " AND ".join(f"({r})" for r in rules.values()) or "TRUE"


def _not_null(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _case_labels() -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PRIORITY_LABELS.items())
    return f"CASE prio_code {arms} ELSE 'Unknown' END"


def oracle_built() -> dict[str, str]:
    """Per layer: the SQL of the frame BEFORE its rules (what the rules see),
    as a CTE body referring to the previous layers by name."""
    cuts = []
    acc = 0.0
    for w in WEIGHTS[:-1]:
        acc += w
        cuts.append(acc / float(sum(WEIGHTS)))
    md5 = f"md5(concat_ws('-', '{SEED}', CAST(o_orderkey AS VARCHAR)))"
    split_case = (
        f"CASE WHEN rn <= floor({cuts[0]!r}::DOUBLE * n + 0.5::DOUBLE) THEN 'train' "
        f"WHEN rn <= floor({cuts[1]!r}::DOUBLE * n + 0.5::DOUBLE) THEN 'validation' ELSE 'test' END"
    )
    cols = ", ".join
    return {
        "bronze": (
            f"SELECT * FROM (SELECT {cols(ORDER_COLS)}, "
            "TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_code, "
            f"CAST({ID_BASE} + o_orderkey AS BIGINT) AS caseid FROM orders) "
            f"WHERE {_not_null(BRONZE_COLS)}"
        ),
        "silver_typed": (
            f"SELECT {cols(BRONZE_COLS)}, {_case_labels()} AS prio_mapped, "
            "TRY_CAST(substr(CAST(caseid AS VARCHAR), 5, 10) AS INTEGER) AS caseid_int FROM bronze"
        ),
        "silver_scaled": (
            f"SELECT {cols(SCALED_COLS)} FROM (SELECT *, CASE WHEN sd_n IS NULL OR sd_n = 0 THEN 0.0 "
            "ELSE (o_totalprice_normalized - mean_n) / sd_n END AS o_totalprice_standardized FROM ("
            "SELECT *, avg(o_totalprice_normalized) OVER () AS mean_n, "
            "stddev_samp(o_totalprice_normalized) OVER () AS sd_n FROM ("
            f"SELECT {cols(TYPED_COLS)}, CASE WHEN mx = mn THEN 0.5 "
            "ELSE (o_totalprice - mn) / (mx - mn) END AS o_totalprice_normalized "
            "FROM silver_typed, (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM silver_typed)))) "
            f"WHERE {_not_null(SCALED_COLS)}"
        ),
        "silver_split": (
            f"SELECT {cols(SCALED_COLS)}, strata, strata_index, {split_case} AS split FROM ("
            "SELECT s.*, i.strata_index, "
            f"row_number() OVER (PARTITION BY s.strata ORDER BY {md5}, o_orderkey) AS rn, "
            "count(*) OVER (PARTITION BY s.strata) AS n FROM ("
            "SELECT *, concat_ws('_', o_orderstatus, o_orderpriority) AS strata FROM silver_scaled) s "
            "JOIN (SELECT strata, CAST(row_number() OVER (ORDER BY count(*) DESC, strata) - 1 AS DOUBLE) "
            "AS strata_index FROM (SELECT concat_ws('_', o_orderstatus, o_orderpriority) AS strata "
            "FROM silver_scaled) GROUP BY strata) i ON s.strata = i.strata)"
        ),
        "gold_full": f"SELECT {cols(GOLD_COLS)} FROM silver_split WHERE {_not_null(SPLIT_COLS)}",
        "gold_splits": f"SELECT {cols(GOLD_SPLIT_COLS)} FROM silver_split WHERE {_not_null(SPLIT_COLS)}",
    }


def oracle_chain(upto: str) -> str:
    """``WITH`` clause defining every layer up to ``upto`` (rules applied);
    ``<name>__built`` is the frame before the rules."""
    built = oracle_built()
    ctes = []
    for name in LAYER_NAMES:
        ctes.append(f"{name}__built AS ({built[name]})")
        ctes.append(f"{name} AS (SELECT * FROM {name}__built WHERE {_sql_rules(ORACLE_RULES[name])})")
        if name == upto:
            break
    return "WITH " + ",\n".join(ctes) + "\n"
