from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("strata_tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def survey_rows():
    """Hand-made survey rows (bronze schema), valid unless overridden."""
    from strata_engine.plans import survey

    def make(**overrides):
        row = {c: 1 for c in survey.INT_COLUMNS}
        row.update({"YEAR": 2021, "AGE": 5, "NUMMHS": 1, "CASEID": 20210000001})
        row.update(overrides)
        return tuple(row[c] for c in survey.INT_COLUMNS + [survey.ID_COLUMN])

    return make
