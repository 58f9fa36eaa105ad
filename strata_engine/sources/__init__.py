"""Readers and writers (sources and sinks)."""

from strata_engine.sources.drift import file_drift, read_csv_drifted  # noqa: F401
from strata_engine.sources.readers import read_csv, read_parquet, read_table, register  # noqa: F401
from strata_engine.sources.writers import drop_tables, save_csv, save_parquet, save_salted, save_table  # noqa: F401
