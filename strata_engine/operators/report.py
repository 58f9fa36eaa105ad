"""Reports over split results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.functions.numeric import round_half_away
from strata_engine.session import collect_small, materialize


def split_report(df: DataFrame, split_col: str = "split", strata_col: str = "demographic_strata",
                 decimals: int | None = None) -> DataFrame:
    """Rows per (split, stratum) with the share of the split and the share of
    the stratum.

    The data is aggregated once (partial per task) to one row per (split,
    stratum), and that count table is brought to one place once: kept as a
    local table when under the session bound, else written to the shared
    checkpoint folder. Split and stratum totals are aggregates of it joined
    back: the input plan runs once and no task holds all strata of a split.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(split_col).alias("split"), F.col(strata_col).alias("strata")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = collect_small(counts)
    counts = spark.createDataFrame(rows, counts.schema) if rows is not None else materialize(counts, "split_counts")
    split_tot = counts.groupBy("split").agg(F.sum("n").alias("__split_n"))
    strata_tot = counts.groupBy("strata").agg(F.sum("n").alias("__strata_n"))
    if rows is not None:  # derived from a size-checked local table
        split_tot, strata_tot = F.broadcast(split_tot), F.broadcast(strata_tot)
    joined = (
        counts.join(split_tot, counts["split"].eqNullSafe(split_tot["split"]))
        .drop(split_tot["split"])
        .join(strata_tot, counts["strata"].eqNullSafe(strata_tot["strata"]))
        .drop(strata_tot["strata"])
    )
    rnd = (lambda c: round_half_away(c, decimals)) if decimals is not None else (lambda c: c)
    return joined.select(
        "split", "strata", "n",
        rnd(F.col("n") / F.col("__split_n")).alias("share_of_split"),
        rnd(F.col("n") / F.col("__strata_n")).alias("share_of_strata"),
    )
