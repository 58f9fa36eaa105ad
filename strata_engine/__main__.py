"""Run the survey layer plan on a CSV file, directory or glob:

    python -m strata_engine <csv> <output_root> [--infer-schema]
    spark-submit --py-files strata_engine.zip strata_engine/__main__.py <csv> <output_root>

Every layer is written under ``<output_root>/<layer>`` (parquet); the run
log and the pipeline report are printed. The session comes from the
launcher (``getOrCreate``), so cluster settings apply.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from strata_engine.plans import survey
from strata_engine.plans.layers import pipeline_report, run_log


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="strata_engine", description="survey bronze → silver → gold layers")
    p.add_argument("csv", help="CSV file, directory or glob with a header line")
    p.add_argument("output_root", help="folder for the layer tables (shared storage on a cluster)")
    p.add_argument("--infer-schema", action="store_true", help="infer column types instead of the declared schema")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("strata_engine_survey").getOrCreate()
    raw = survey.read_raw(spark, args.csv, infer_schema=args.infer_schema)
    results = survey.run(spark, raw, args.output_root.rstrip("/"))
    run_log(spark, results).orderBy("layer", "metric").show(200, truncate=False)
    pipeline_report(results, {"silver_2": survey.SCALED_OUT}).filter("item != 'type'").show(50, truncate=False)
    return results


if __name__ == "__main__":
    main(sys.argv[1:])
