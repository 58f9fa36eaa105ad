"""strata_engine: layered (bronze / silver / gold) table refinement on Spark.

Every operator is a plain DataFrame → DataFrame function built from native
Spark expressions; see ``operators``, ``functions``, ``sources``, ``plans``
and ``streaming``. The most used ones are re-exported here.
"""

from strata_engine.functions import rules
from strata_engine.operators.clean import drop_columns, drop_null_rows
from strata_engine.operators.profile import describe, group_summary, preview, row_count, summarize
from strata_engine.operators.quality import enforce, flag, observe_rules, proportions, report
from strata_engine.operators.report import split_report
from strata_engine.operators.scale import min_max, min_max_z, scale, z_score
from strata_engine.operators.schema import check as check_schema
from strata_engine.operators.schema import diff as schema_diff
from strata_engine.operators.schema import summary as schema_summary
from strata_engine.operators.split import (
    hash_split,
    random_split,
    random_split_column,
    read_split,
    save_splits,
    stratified_split,
    three_way,
)
from strata_engine.operators.strata import add_exact_strata, add_strata, frequency_index, split_strata, value_counts
from strata_engine.operators.summary import summary
from strata_engine.operators.transform import cast_columns, id_suffix, map_codes, map_codes_lookup
from strata_engine.operators.verdicts import read_kept, read_quarantined, save_verdicts
from strata_engine.plans.layers import Layer, layer, pipeline_report, run_layer, run_log, run_pipeline
from strata_engine.plans.publish import publish, run_published
from strata_engine.sources import (
    drop_tables,
    file_drift,
    read_csv,
    read_csv_drifted,
    read_parquet,
    read_table,
    register,
    save_csv,
    save_parquet,
    save_salted,
    save_table,
)

__version__ = "0.1.0"

__all__ = [
    "Layer", "add_exact_strata", "add_strata", "cast_columns", "check_schema", "describe", "drop_columns", "drop_null_rows",
    "drop_tables", "enforce", "file_drift", "flag", "frequency_index", "group_summary", "hash_split", "id_suffix", "layer",
    "map_codes", "map_codes_lookup", "min_max", "min_max_z", "observe_rules", "pipeline_report", "preview",
    "proportions", "publish", "random_split", "random_split_column", "read_csv", "read_csv_drifted", "read_kept", "read_parquet",
    "read_quarantined", "read_split", "read_table", "register", "report", "row_count", "rules", "run_layer", "run_log",
    "run_pipeline", "run_published", "save_csv", "save_parquet", "save_salted", "save_splits", "save_table", "save_verdicts",
    "scale", "schema_diff", "schema_summary", "split_report", "split_strata", "stratified_split", "summarize", "summary",
    "three_way", "value_counts", "z_score",
]
