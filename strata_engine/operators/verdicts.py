"""One pass, two sinks: rows that pass a rule set and rows that do not.

The rules are evaluated once per row into a verdict and the list of failed
rules, and both kinds of rows go out in one partitioned write. Either side is
read back by partition pruning, so reading the kept rows never opens a file
of the quarantined ones. (Filtering twice, once per sink, would scan the
input and evaluate every rule twice.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from strata_engine.operators.quality import flag
from strata_engine.sources.writers import save_parquet

VERDICT = "strata_verdict"
KEPT, QUARANTINED = "kept", "quarantined"
FAILED = "failed_rules"


def judge(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """All rows, with ``failed_rules`` (names in rule order, empty when the
    row passes; NULL counts as a failure) and ``strata_verdict``."""
    taken = [c for c in df.columns if c.lower() in (VERDICT, FAILED)]
    if taken:
        raise ValueError(f"the input already has {taken}")
    flagged = flag(df, rules, FAILED)
    return flagged.withColumn(VERDICT, F.when(F.size(FAILED) == 0, F.lit(KEPT)).otherwise(F.lit(QUARANTINED)))


def observe_counts(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregates to the next action on ``df``."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def save_verdicts(
    df: DataFrame, rules: Mapping[str, str], path: str, partition_by: Sequence[str] = (), compression: str = "snappy"
) -> dict[str, int]:
    """Write ``df`` to ``path`` with the verdict as the first partition level
    (below it ``partition_by``); no shuffle, one pass. Returns how many rows
    went each way, counted by the write itself (an empty input: zeros)."""
    kept = F.col(VERDICT) == KEPT
    judged, seen = observe_counts(judge(df, rules), "verdicts", **{KEPT: F.count_if(kept), QUARANTINED: F.count_if(~kept)})
    save_parquet(judged, path, [VERDICT, *partition_by], compression=compression, cluster_by=())
    return {k: int(seen.get.get(k, 0)) for k in (KEPT, QUARANTINED)}


def _read(spark: SparkSession, path: str, schema: StructType, verdict: str) -> DataFrame:
    whole = StructType([*schema.fields, StructField(FAILED, ArrayType(StringType())), StructField(VERDICT, StringType())])
    return spark.read.schema(whole).parquet(path).where(F.col(VERDICT) == verdict)


def read_kept(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that passed, with the columns of ``schema`` (that of the
    frame given to :func:`save_verdicts`), in its order."""
    return _read(spark, path, schema, KEPT).select(*schema.fieldNames())


def read_quarantined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that failed, with ``failed_rules`` as last column."""
    return _read(spark, path, schema, QUARANTINED).select(*schema.fieldNames(), FAILED)
