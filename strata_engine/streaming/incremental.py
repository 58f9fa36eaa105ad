"""Incremental bronze → silver for files that keep arriving.

Only the row-local steps run on a stream: NULL-row drop, rules (drop),
code labels, identifier suffix and the key-hash split. They need no state,
so each micro-batch is processed on its own and the file sink with a
checkpoint gives exactly-once output. Steps that need the whole table
(scaling fits, frequency index, stratified split) stay batch steps over the
written table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata_engine.operators.clean import drop_null_rows
from strata_engine.operators.quality import enforce
from strata_engine.operators.split import hash_split
from strata_engine.operators.transform import id_suffix, map_codes


def row_local_layer(
    df: DataFrame,
    rules: Mapping[str, str],
    code_lists: Mapping[str, Mapping[object, str]] | None = None,
    id_column: str | None = None,
    split_key: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """The stateless part of the layer plan; valid on batch and stream."""
    out = enforce(drop_null_rows(df), rules, "drop")
    if code_lists:
        out = map_codes(out, code_lists)
    if id_column:
        out = id_suffix(out, id_column, f"{id_column}_int")
    if split_key:
        out = hash_split(out, list(split_key), seed=seed)
    return out


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet table. ``checkpoint`` is a folder on
    shared storage, the same one on every restart: with it restarts are
    exactly-once; with a new one the sink would take old batches for done."""
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder that outlives the session")
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(path)


def survey_stream(spark: SparkSession, csv_dir: str, out_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Survey CSV files arriving in ``csv_dir`` → bronze rules, code labels,
    identifier suffix and a key-hash split → parquet partitioned by split."""
    from strata_engine.plans import survey

    reader = spark.readStream.schema(survey.BRONZE_SCHEMA).option("header", "true").option("enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(csv_dir)
    rows = row_local_layer(raw, survey.BRONZE_RULES, survey.CODE_LISTS, survey.ID_COLUMN, [survey.ID_COLUMN],
                           seed=survey.SEED)
    return start_file_sink(rows, out_path, checkpoint, partition_by=["split"], name="survey_stream")
