"""Shuffle records of the stratified split vs a per-stratum window, read
from Spark's event log (written to a fresh scratch folder).

Usage: python tools/shuffle_evidence.py [sf_dir] [target_rows]
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    given = {"target_rows": int(sys.argv[2])} if len(sys.argv) > 2 else {}  # else the default
    log_dir = tempfile.mkdtemp(prefix="run-evlog-")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from strata_engine.functions.hashing import hash_hex
    from strata_engine.operators import split, strata

    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = strata.add_strata(o, ["o_orderstatus", "o_orderpriority"], "strata")
    spark.sparkContext.setJobGroup("per_stratum_window", "naive")
    w = Window.partitionBy("strata").orderBy(hash_hex(["o_orderkey"], 42), "o_orderkey")
    o.withColumn("rn", F.row_number().over(w)).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("stratified_split", "ours")
    split.stratified_split(o, "strata", ["o_orderkey"], **given).write.format("noop").mode("overwrite").save()
    spark.stop()

    path = glob.glob(f"{log_dir}/**/events_*", recursive=True)[0]
    raw = open(path, "rb").read()
    text = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")).read().decode() if path.endswith(".zstd") else raw.decode()
    stage_group, recs, size = {}, collections.Counter(), collections.Counter()
    for line in text.splitlines():
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id", "?")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif e.get("Event") == "SparkListenerTaskEnd":
            sw = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
            g = stage_group.get(e.get("Stage ID"), "?")
            recs[g] += sw.get("Shuffle Records Written", 0)
            size[g] += sw.get("Shuffle Bytes Written", 0)
    print(json.dumps({g: {"shuffle_records": recs[g], "shuffle_bytes": size[g]} for g in recs if g != "?"}))


if __name__ == "__main__":
    main()
