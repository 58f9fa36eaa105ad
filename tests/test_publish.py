"""Versioned publish, resume, partition replacement, and the two-sink write."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from strata_engine.operators import verdicts
from strata_engine.plans import publish as P
from strata_engine.plans.layers import Layer, run_layer

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROWS = [(1, "a", 5), (2, "a", -1), (3, "b", 7), (4, "b", None), (5, None, 9)]
SCHEMA = "id int, kind string, v int"


@pytest.fixture()
def source(spark, tmp_path):
    def make(rows=ROWS, name="src"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make


def plan(calls, fail=()):
    def base(inputs):
        calls.append("base")
        return inputs["raw"].withColumn("w", F.col("v") * 2)

    def mid(inputs):
        calls.append("mid")
        if "mid" in fail:
            raise RuntimeError("lost")
        return inputs["base"].withColumn("x", F.lit("m"))

    def top(inputs):
        calls.append("top")
        out = inputs["mid"].withColumn("y", F.col("w") + 1)
        return out.withColumn("y", F.raise_error(F.lit("lost in a task"))) if "top" in fail else out

    return [
        Layer("base", base, {"positive": "v > 0"}, partition_by=["kind"], quarantine=True),
        Layer("mid", mid),
        Layer("top", top, {"low": "y < 100"}, partition_by=["kind"]),
    ]


def ids(df):
    return sorted(r.id for r in df.collect())


def test_publish_reads_back_both_sides_and_older_versions(spark, source, tmp_path):
    root, calls = str(tmp_path / "pub"), []
    first = P.run_published(spark, plan(calls), root, {"raw": source()})
    assert [r.version for r in first.values()] == [1, 1, 1] and not any(r.resumed for r in first.values())
    assert ids(P.read(spark, root, "base")) == [1, 3, 5] and first["base"].rows_in == 5 and first["base"].rows_out == 3
    away = P.read(spark, root, "base", quarantined=True)
    assert {r.id: r.failed_rules for r in away.collect()} == {2: ["positive"], 4: ["positive"]}
    assert P.read(spark, root, "top").columns == ["id", "kind", "v", "w", "x", "y"]
    assert dict(P.read(spark, root, "base").dtypes) == {"id": "int", "kind": "string", "v": "int", "w": "int"}
    with pytest.raises(P.NotPublished):
        P.read(spark, root, "top", quarantined=True)
    with pytest.raises(P.NotPublished):
        P.read(spark, root, "nothing")
    again = source([(9, "c", 1)], "src2")
    second = P.run_published(spark, plan(calls), root, {"raw": again})
    assert [r.version for r in second.values()] == [2, 2, 2]
    assert ids(P.read(spark, root, "top")) == [9] and ids(P.read(spark, root, "top", number=1)) == [1, 3, 5]
    with pytest.raises(P.NotPublished):
        P.read(spark, root, "top", number=7)


def test_unchanged_plan_runs_nothing_and_changes_run_what_depends_on_them(spark, source, tmp_path):
    root, calls, raw = str(tmp_path / "pub"), [], source()
    layers = plan(calls)
    P.run_published(spark, layers, root, {"raw": raw})
    calls.clear()
    done = P.run_published(spark, layers, root, {"raw": raw, "unused": source(ROWS[:1], "other")})
    assert calls == [] and all(r.resumed for r in done.values()) and done["base"].failed == {"positive": 2}
    layers[1].revision = "2"
    done = P.run_published(spark, layers, root, {"raw": raw})
    assert calls == ["mid", "top"] and done["base"].resumed and done["top"].version == 2
    calls.clear()
    spark.createDataFrame(ROWS[:2], SCHEMA).write.mode("append").parquet(str(tmp_path / "src"))
    P.run_published(spark, layers, root, {"raw": spark.read.parquet(str(tmp_path / "src"))})
    assert calls == ["base", "mid", "top"]
    calls.clear()
    P.run_published(spark, layers, root, {"raw": raw}, upto="base", force=True)
    assert calls == ["base"]


@pytest.mark.parametrize("where", ["mid", "top"])
def test_a_run_that_fails_leaves_the_old_versions_and_is_resumed(spark, source, tmp_path, where):
    root, calls = str(tmp_path / "pub"), []
    P.run_published(spark, plan(calls), root, {"raw": source()})
    changed = source([(9, "c", 1)], "src2")
    with pytest.raises(Exception, match="lost"):
        P.run_published(spark, plan(calls, fail=(where,)), root, {"raw": changed})
    assert ids(P.read(spark, root, "base")) == [9]
    assert ids(P.read(spark, root, "top")) == [1, 3, 5]  # whole, of the run before
    calls.clear()
    P.run_published(spark, plan(calls), root, {"raw": changed})
    assert calls == (["mid", "top"] if where == "mid" else ["top"])
    assert ids(P.read(spark, root, "top")) == [9]


def test_a_killed_process_is_resumed(spark, source, tmp_path):
    source()
    root = str(tmp_path / "pub")
    script = textwrap.dedent(f"""
        import os, sys
        sys.path[:0] = [{REPO!r}, {os.path.join(REPO, "tests")!r}]
        from strata_engine.session import local_session
        from strata_engine.plans import publish as P
        from test_publish import plan
        spark = local_session(2, 2)
        layers = plan([])
        layers[2].build = lambda inputs: os._exit(9)
        P.run_published(spark, layers, {root!r}, {{"raw": spark.read.parquet({str(tmp_path / "src")!r})}})
    """)
    ended = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300)
    assert ended.returncode == 9, ended.stderr[-2000:]
    assert P.latest(spark, root, "mid").number == 1 and P.latest(spark, root, "top") is None
    calls = []
    done = P.run_published(spark, plan(calls), root, {"raw": spark.read.parquet(str(tmp_path / "src"))})
    assert calls == ["top"] and done["mid"].resumed and ids(done["top"].frame) == [1, 3, 5]


def test_half_written_versions_and_broken_manifests_are_not_read(spark, source, tmp_path):
    root = str(tmp_path / "pub")
    P.run_published(spark, plan([]), root, {"raw": source()})
    spark.createDataFrame([(99, "a", 1)], SCHEMA).write.parquet(f"{root}/top/{P.VERSION}=2-feedbeef")
    os.makedirs(f"{root}/top/_manifests", exist_ok=True)
    for number, text in ((2, "{"), (3, '{"layer": "top"}'), (4, '{"folders": 3}')):
        with open(f"{root}/top/_manifests/{number:010d}.json", "w") as f:
            f.write(text)
    gone = P.latest(spark, root, "top")
    assert gone.number == 1 and ids(P.read(spark, root, "top")) == [1, 3, 5]
    done = P.run_published(spark, plan([]), root, {"raw": source(ROWS[:1], "src3")})
    assert done["top"].version == 5 and ids(P.read(spark, root, "top")) == [1]
    left = P.prune(spark, root, "top", keep=1)
    assert f"{P.VERSION}=2-feedbeef" in left and ids(P.read(spark, root, "top")) == [1]
    with pytest.raises(P.NotPublished):
        P.read(spark, root, "top", number=1)


def test_partitions_are_replaced_and_nothing_else(spark, source, tmp_path):
    root, layers = str(tmp_path / "pub"), plan([])
    P.run_published(spark, layers, root, {"raw": source()}, upto="base")
    files = {f for f in P.read(spark, root, "base").inputFiles() if "kind=b" in f}
    P.publish(spark, layers[0], {"raw": source([(20, "a", 1), (21, None, -3)], "part")}, root, partitions_only=True)
    now = P.read(spark, root, "base")
    assert ids(now) == [3, 20] and ids(P.read(spark, root, "base", quarantined=True)) == [4, 21]
    assert {f for f in now.inputFiles() if "kind=b" in f} == files
    assert ids(P.read(spark, root, "base", number=1)) == [1, 3, 5]
    P.publish(spark, layers[0], {"raw": source([(30, "b", 1)], "part2")}, root, partitions_only=True)
    assert ids(P.read(spark, root, "base")) == [20, 30] and ids(P.read(spark, root, "base", quarantined=True)) == [21]
    # earlier layers' new versions make later layers run again
    calls = []
    done = P.run_published(spark, [layers[0], *plan(calls)[1:]], root, {"raw": spark.read.parquet(str(tmp_path / "src"))})
    assert done["base"].resumed and ids(done["top"].frame) == [20, 30]
    with pytest.raises(ValueError):
        P.publish(spark, Layer("flat", lambda i: i["raw"]), {"raw": source()}, root, partitions_only=True)
    with pytest.raises(P.NotPublished):
        P.publish(spark, Layer("new", lambda i: i["raw"], partition_by=["kind"]), {"raw": source()}, root, partitions_only=True)


def test_empty_layers_and_lost_races(spark, source, tmp_path):
    root, layers = str(tmp_path / "pub"), plan([])
    done = P.run_published(spark, layers, root, {"raw": source([])})
    assert [r.frame.count() for r in done.values()] == [0, 0, 0] and done["base"].quarantined.count() == 0
    store = P._Store(spark, f"{root}/base")
    with pytest.raises(P.PublishConflict):
        store.put("_manifests/0000000001.json", "{}")
    assert P.latest(spark, root, "base").number == 1


def test_sources_are_known_by_their_files(spark, source, tmp_path):
    a, b = source(), source(ROWS, "copy")
    assert P.source_identity(a) == P.source_identity(spark.read.parquet(str(tmp_path / "src"))) != P.source_identity(b)
    assert P.source_identity(spark.range(3)).startswith("plan:")


def test_two_sinks_hold_all_rows_once(spark, tmp_path):
    df = spark.createDataFrame([*ROWS, ROWS[1]], SCHEMA)
    rules = {"positive": "v > 0", "known": "kind is not null and kind <> 'b'"}
    path = str(tmp_path / "v")
    assert verdicts.save_verdicts(df, rules, path, partition_by=["kind"]) == {"kept": 1, "quarantined": 5}
    kept, away = verdicts.read_kept(spark, path, df.schema), verdicts.read_quarantined(spark, path, df.schema)
    assert kept.columns == df.columns and ids(kept) == [1]
    assert sorted((r.id, tuple(r.failed_rules)) for r in away.collect()) == [
        (2, ("positive",)), (2, ("positive",)), (3, ("known",)), (4, ("positive", "known")), (5, ("known",)),
    ]
    plan_text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(strata_verdict" in plan_text
    with pytest.raises(ValueError):
        verdicts.judge(df.withColumn("failed_rules", F.lit(1)), rules)
    empty = str(tmp_path / "e")
    assert verdicts.save_verdicts(df.limit(0), rules, empty) == {"kept": 0, "quarantined": 0}
    assert verdicts.read_kept(spark, empty, df.schema).count() == 0


def test_layer_quarantine_without_publishing(spark, tmp_path):
    layer = Layer("q", lambda i: i["raw"], {"positive": "v > 0"}, quarantine=True)
    got = run_layer(spark, layer, {"raw": spark.createDataFrame(ROWS, SCHEMA)}, str(tmp_path))
    assert ids(got.frame) == [1, 3, 5] and ids(got.quarantined) == [2, 4]
    assert (got.rows_in, got.rows_out, got.failed) == (5, 3, {"positive": 2})
