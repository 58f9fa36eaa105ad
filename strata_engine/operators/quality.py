"""Named SQL quality rules: drop, flag, count, and codebook proportions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata_engine.functions.rules import conjunction
from strata_engine.session import collect_small, materialize


class RuleViolation(ValueError):
    """Raised by ``enforce(action="fail")``."""


def _passes(rule: str) -> Column:
    # NULL counts as a failure, as in a WHERE clause.
    return F.coalesce(F.expr(rule), F.lit(False))


def enforce(df: DataFrame, rules: Mapping[str, str], action: str = "drop") -> DataFrame:
    """Apply a rule set.

    ``drop``: keep rows passing every rule. The rules go into one plain
    ``filter`` so simple comparisons reach the parquet scan as pushed filters.
    ``flag``: keep all rows, add ``failed_rules`` (see :func:`flag`).
    ``fail``: raise if any row fails (one aggregate job), else return ``df``.
    """
    if action == "drop":
        return df.filter(conjunction(dict(rules))) if rules else df
    if action == "flag":
        return flag(df, rules)
    if action == "fail":
        bad = report(df, rules).filter("n_failed > 0").collect()
        if bad:
            raise RuleViolation(", ".join(f"{r.rule}: {r.n_failed}" for r in bad))
        return df
    raise ValueError(f"unknown action {action!r}")


def flag(df: DataFrame, rules: Mapping[str, str], out: str = "failed_rules") -> DataFrame:
    """Keep every row; ``out`` is the array of names of the rules it fails
    (empty when it passes all), in rule order."""
    none = F.array().cast("array<string>")
    # concat of short arrays stays in generated code; a filter lambda would not
    failed = [F.when(_passes(r), none).otherwise(F.array(F.lit(name))) for name, r in rules.items()]
    return df.withColumn(out, F.concat(*failed) if failed else none)


def passes(df: DataFrame, rules: Mapping[str, str], prefix: str = "") -> DataFrame:
    """Keep every row; add one boolean per rule (``prefix`` + rule name)."""
    return df.withColumns({f"{prefix}{name}": _passes(r) for name, r in rules.items()})


def _stack(pairs: list[tuple[str, str]], value_name: str) -> Column:
    """``stack`` of (label literal, column) pairs into (position, rule, value)."""
    args = []
    for i, (label, col) in enumerate(pairs):
        esc = label.replace("\\", "\\\\").replace("'", "\\'")
        args.append(f"{i}, '{esc}', `{col}`")
    return F.expr(f"stack({len(pairs)}, {', '.join(args)}) AS (position, rule, {value_name})")


def report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: position, rule, n_passed, n_failed, n_total.

    One aggregate over the data (partial counts per task, a single small
    final merge), then unpivot; passed + failed = total for each rule.
    """
    names = list(rules)
    aggs = [F.count_if(_passes(rules[n])).alias(f"__p{i}") for i, n in enumerate(names)]
    totals = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    if not names:
        return totals.select(
            F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("rule"),
            F.lit(0).cast("bigint").alias("n_passed"), F.lit(0).cast("bigint").alias("n_failed"),
            F.col("__n").alias("n_total"),
        ).limit(0)
    stacked = totals.select("__n", _stack([(n, f"__p{i}") for i, n in enumerate(names)], "n_passed"))
    return stacked.select(
        F.col("position").cast("int").alias("position"),
        "rule",
        F.col("n_passed").cast("bigint").alias("n_passed"),
        (F.col("__n") - F.col("n_passed")).cast("bigint").alias("n_failed"),
        F.col("__n").cast("bigint").alias("n_total"),
    )


def observe_rules(df: DataFrame, rules: Mapping[str, str], name: str) -> tuple[DataFrame, Observation]:
    """Attach row and per-rule failure counts to ``df`` without another pass:
    the numbers are filled in when the next action (e.g. the save) runs."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~_passes(r)).alias(f"failed:{n}") for n, r in rules.items()]
    return df.observe(obs, *metrics), obs


def proportions(
    df: DataFrame,
    col: str,
    expected: Mapping[str, float] | None = None,
    tolerance: float = 0.01,
) -> DataFrame:
    """Share of each value of ``col`` (NULL included as its own value).

    Counts are pre-aggregated per task, so a hot value costs nothing extra;
    the count table (one row per value) is computed once, kept local when
    under the session bound, else written to the checkpoint folder; the
    total comes from it, not from a single-partition window. With
    ``expected`` ({value: share}, the codebook), adds expected_share,
    abs_diff and within_tolerance; values present on only one side are kept.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # the count table is computed once: local when small, else written
    rows = collect_small(counts)
    if rows is not None:
        counts = spark.createDataFrame(rows, counts.schema)
        total = F.lit(sum(r["n"] for r in rows))
    else:
        counts = materialize(counts, "proportions")
        total = counts.select(F.sum("n")).scalar()
    observed = counts.select("value", "n", (F.col("n") / total).alias("share"))
    if expected is None:
        return observed
    schema = StructType([StructField("value", StringType()), StructField("expected_share", DoubleType())])
    exp = spark.createDataFrame([(str(k), float(v)) for k, v in expected.items()], schema)
    joined = observed.join(exp, observed["value"].eqNullSafe(exp["value"]), "full_outer")
    share = F.coalesce(F.col("share"), F.lit(0.0))
    exp_share = F.coalesce(F.col("expected_share"), F.lit(0.0))
    diff = F.abs(share - exp_share)
    return joined.select(
        F.coalesce(observed["value"], exp["value"]).alias("value"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        share.alias("share"),
        F.col("expected_share"),
        diff.alias("abs_diff"),
        (diff <= F.lit(tolerance)).alias("within_tolerance"),
    )
