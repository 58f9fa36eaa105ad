"""Layered tables: each layer is a named ``DataFrame -> DataFrame`` step with
a rule set, an optional schema contract and a partitioning, run by a plain
loop (no scheduler).

One layer run = read upstream layers (already saved) → build → cluster by
the partition columns → count rows and per-rule failures (``observe``: no
extra pass, in the write's result stage) → drop failing rows → check the
schema → save ONCE, partitioned → read back. Every layer is a
written table in the shared checkpoint folder, which also cuts the lineage
between layers: a lost executor recomputes at most one layer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from strata_engine.operators.quality import enforce, observe_rules, report
from strata_engine.operators.schema import check
from strata_engine.operators.verdicts import KEPT, VERDICT, judge, observe_counts, read_kept, read_quarantined
from strata_engine.session import wide_plan
from strata_engine.sources.readers import BAD_VALUES
from strata_engine.sources.writers import cluster_for_write, save_parquet


@dataclass
class Layer:
    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    rules: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None  # a failing contract; DDL text or a StructType
    partition_by: Sequence[str] = ()
    schema_mode: str = "names_types"
    compression: str = "snappy"
    # counted and reported, rows kept (the "expect" without "or drop")
    warn_rules: Mapping[str, str] = field(default_factory=dict)
    # REBALANCE by the partition columns before the write: needed when they
    # have many value combinations (else every task writes into every
    # directory); a single low-cardinality column (e.g. split) needs no
    # shuffle — each task writes at most that many files
    cluster: bool = True
    # drop rows with a NULL in any column after counting them (run log:
    # rows_read, null_rows, and bad:<column> for a frame with BAD_VALUES)
    drop_nulls: bool = False
    # keep the rows that fail a rule beside the layer, with the rules they
    # fail (one write, see operators.verdicts); they stay out of ``frame``
    quarantine: bool = False
    # part of a published layer's identity: change it when what ``build``
    # calls has changed (its own source text is looked at anyway)
    revision: str = ""


def layer(
    name: str,
    rules: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    warn_rules: Mapping[str, str] | None = None,
    schema_mode: str = "names_types",
    cluster: bool = True,
    drop_nulls: bool = False,
    quarantine: bool = False,
    revision: str = "",
) -> Callable[[Callable[[Mapping[str, DataFrame]], DataFrame]], Layer]:
    """Declare a layer on its build function::

        @layer("bronze", rules=BRONZE_RULES, schema=BRONZE_SCHEMA, partition_by=["GENDER"])
        def bronze(inputs):
            return drop_null_rows(inputs["raw"])

    The decorated name is the :class:`Layer`; run it with ``run_pipeline``.
    """
    def wrap(fn: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Layer:
        return Layer(name, fn, dict(rules or {}), schema, list(partition_by), schema_mode,
                     warn_rules=dict(warn_rules or {}), cluster=cluster, drop_nulls=drop_nulls,
                     quarantine=quarantine, revision=revision)
    return wrap


@dataclass
class LayerResult:
    name: str
    frame: DataFrame
    path: str
    rows_in: int
    rows_out: int
    failed: dict[str, int]
    warned: dict[str, int] = field(default_factory=dict)
    lost: dict[str, int] = field(default_factory=dict)  # rows_read, null_rows, bad:<column>
    quarantined: DataFrame | None = None  # with ``failed_rules``, if the layer keeps them
    version: int | None = None  # of a published layer
    resumed: bool = False  # a published layer that was up to date and not run


def run_layer(
    spark: SparkSession, layer: Layer, inputs: Mapping[str, DataFrame], root: str, path: str | None = None
) -> LayerResult:
    """Run one layer into ``path`` (default: the folder of its name in ``root``)."""
    with wide_plan(spark):
        return _run_layer(spark, layer, inputs, path or f"{root}/{layer.name}")


def _run_layer(spark: SparkSession, layer: Layer, inputs: Mapping[str, DataFrame], path: str) -> LayerResult:
    built = layer.build(inputs)
    columns = [c for c in built.columns if c != BAD_VALUES]
    warn = {f"warn:{k}": v for k, v in layer.warn_rules.items()}
    # cluster first, so the counters below run in the write's result stage,
    # where a retried task's updates count once (in a shuffle-map stage a
    # re-run after a lost executor could count rows twice)
    clustered = cluster_for_write(built, layer.partition_by) if layer.cluster else built
    if layer.drop_nulls:
        # the losses, then (of the rows without NULL) the rules, in one pass
        whole = ~_any_null(columns)
        clustered, obs_read = _observe_losses(clustered, columns, f"{layer.name}_read")
        clustered = clustered.where(whole)
    else:
        obs_read = None
    clustered = clustered.select(*columns)
    observed, obs_in = observe_rules(clustered, {**layer.rules, **warn}, f"{layer.name}_in")
    kept = enforce(observed, layer.rules, "drop")
    if layer.schema is not None:
        declared = StructType.fromDDL(layer.schema) if isinstance(layer.schema, str) else layer.schema
        check(kept, declared, layer.schema_mode)
    quarantined = None
    if layer.quarantine:
        judged = judge(observed, layer.rules)
        judged, obs_out = observe_counts(judged, f"{layer.name}_out", rows=F.count_if(F.col(VERDICT) == KEPT))
        save_parquet(judged, path, [VERDICT, *layer.partition_by], compression=layer.compression, cluster_by=())
        frame = read_kept(spark, path, kept.schema)
        quarantined = read_quarantined(spark, path, kept.schema)
    else:
        kept, obs_out = observe_rules(kept, {}, f"{layer.name}_out")
        save_parquet(kept, path, partition_by=layer.partition_by, compression=layer.compression, cluster_by=())
        # read with the written schema: no inference (an empty layer has no
        # files), partition values keep their types; partition columns come
        # back last, so restore the declared order
        frame = spark.read.schema(kept.schema).parquet(path).select(*columns)
    m_in, m_out = obs_in.get, obs_out.get
    if "rows" in m_in and "rows" in m_out:
        counts = {k.split(":", 1)[1]: int(v) for k, v in m_in.items() if k.startswith("failed:")}
        rows_in, rows_out = int(m_in["rows"]), int(m_out["rows"])
    else:  # an input without partitions gives no metrics
        rep = report(built, {**layer.rules, **warn}).collect()
        counts = {r.rule: int(r.n_failed) for r in rep}
        rows_in = int(built.count()) if not rep else int(rep[0].n_total)
        rows_out = int(frame.count())
    failed = {k: v for k, v in counts.items() if not k.startswith("warn:")}
    warned = {k[len("warn:"):]: v for k, v in counts.items() if k.startswith("warn:")}
    return LayerResult(layer.name, frame, path, rows_in, rows_out, failed, warned, _losses(obs_read), quarantined)


def _losses(obs: Observation | None) -> dict[str, int]:
    if obs is None:
        return {}
    found = obs.get or {"rows_read": 0, "null_rows": 0}  # an input without partitions has none
    return {k: int(v) for k, v in found.items() if v or not k.startswith("bad:")}


def _any_null(columns: Sequence[str]) -> Column:
    null = F.lit(False)
    for c in columns:
        null = null | F.col(f"`{c}`").isNull()
    return null


def _observe_losses(df: DataFrame, columns: Sequence[str], name: str) -> tuple[DataFrame, Observation]:
    """Rows read, rows with a NULL, and per column the values that did not parse."""
    aggs = [F.count(F.lit(1)).alias("rows_read"), F.count_if(_any_null(columns)).alias("null_rows")]
    if BAD_VALUES in df.columns:
        aggs += [F.count_if(F.array_contains(BAD_VALUES, c)).alias(f"bad:{c}") for c in columns]
    obs = Observation(name)
    return df.observe(obs, *aggs), obs


def run_pipeline(
    spark: SparkSession,
    layers: Sequence[Layer],
    root: str,
    sources: Mapping[str, DataFrame] | None = None,
    upto: str | None = None,
) -> dict[str, LayerResult]:
    """Run layers in order; each sees ``sources`` plus all earlier layers
    (read back from storage) by name."""
    frames: dict[str, DataFrame] = dict(sources or {})
    results: dict[str, LayerResult] = {}
    for layer in layers:
        res = run_layer(spark, layer, frames, root)
        results[layer.name] = res
        frames[layer.name] = res.frame
        if layer.name == upto:
            break
    return results


RUN_LOG_SCHEMA = StructType([
    StructField("layer", StringType()),
    StructField("metric", StringType()),
    StructField("value", LongType()),
])


def run_log(spark: SparkSession, results: Mapping[str, LayerResult]) -> DataFrame:
    """One row per (layer, metric): rows_read and null_rows (a layer that
    drops NULL rows), bad:<column> (values that did not parse), rows_in,
    rows_out, failed:<rule> (rows
    dropped), warned:<rule> (rows kept). A row failing several rules is
    counted under each and dropped once."""
    rows = []
    for r in results.values():
        rows += [(r.name, k, v) for k, v in r.lost.items()]
        rows.append((r.name, "rows_in", r.rows_in))
        rows.append((r.name, "rows_out", r.rows_out))
        rows += [(r.name, f"failed:{k}", v) for k, v in r.failed.items()]
        rows += [(r.name, f"warned:{k}", v) for k, v in r.warned.items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


REPORT_SCHEMA = StructType([
    StructField("layer", StringType()),
    StructField("column_name", StringType()),
    StructField("item", StringType()),
    StructField("data_type", StringType()),
    StructField("num_value", DoubleType()),
])


def pipeline_report(
    results: Mapping[str, LayerResult],
    summarize_cols: Mapping[str, Sequence[str]] = (),
    decimals: int | None = 6,
) -> DataFrame:
    """Per layer: each column's type (item ``type``), and for the listed
    columns min / max / mean / stddev (one aggregate per layer, over the
    saved table)."""
    results = dict(results)
    first = next(iter(results.values()))
    spark = first.frame.sparkSession
    type_rows = [
        (r.name, f.name, "type", f.dataType.simpleString(), None)
        for r in results.values()
        for f in r.frame.schema.fields
    ]
    out = spark.createDataFrame(type_rows, REPORT_SCHEMA)
    from strata_engine.operators.profile import summarize

    for layer, cols in dict(summarize_cols).items():
        if layer not in results:
            continue
        s = summarize(results[layer].frame, list(cols), decimals)
        long = s.select(
            F.lit(layer).alias("layer"),
            "column_name",
            F.expr("stack(4, 'min', min, 'max', max, 'mean', mean, 'stddev', stddev) AS (item, num_value)"),
        )
        out = out.unionByName(long.withColumn("data_type", F.lit(None).cast("string")))
    return out
