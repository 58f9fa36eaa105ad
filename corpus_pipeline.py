"""The training-corpus pipeline: five stages over ``documents``.

Each stage works on everything its predecessor kept; every result is written
as Parquet under the shared checkpoint folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata_engine.llm import bin_slack, group_join, langid, quality_forest, seed_extend, word_bpe
from strata_engine.llm.common import fold, table
from strata_engine.session import fits_broadcast, materialize

SEQUENCE_TOKENS = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or the forest. Every row is
    judged by its own text: null and empty texts fail the base rules and go,
    null and repeated ids change nothing. No labelled rows: the base rules
    alone."""
    model = quality_forest.fit(docs, table(spark, sf_dir, "labels"))
    return quality_forest.keep_good(docs, model)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a determined language: texts that are null or
    have no letter, and those whose best language has a probability below
    0.5. Every row is judged by its own text, whatever its id. If no row has a
    language, only texts without a letter go."""
    model = langid.fit(docs, training=fold("doc_id", 4) != 2)
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays.
    Rows with one id are one document: they stay or go together. Rows with a
    null id and texts without words belong to no group and stay."""
    found = group_join.similar_components(docs, words=5, percent=80)
    dropped = materialize(found.where("component_id <> doc_id").select("doc_id").distinct(), "pipeline-dropped")
    dropped = F.broadcast(dropped) if fits_broadcast(dropped) else dropped
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 20 words or more that start earlier in the corpus.
    A text without any stays as it is, null texts and rows with a null id
    among them; no document goes. Alike rows get the same; of rows with one id
    and different texts one is compared, the others stay whole."""
    found = seed_extend.deduplicate(docs, min_words=20, carry=[c for c in docs.columns if c != "doc_id"])
    text = F.when(F.col("n_removed") == 0, F.col("carried.text")).otherwise(F.col("kept"))
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("bigint")}
    return found.select(*[made.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token pieces of all texts into sequences: every row's own,
    repeated and null ids included; a null or empty text is one piece."""
    path = public_tokenizers.path("word_bpe_49k.json")
    # a smaller word cache: executors still hold what earlier stages needed
    pieces = word_bpe.token_pieces(
        docs, path, SEQUENCE_TOKENS, with_ids=False, cached_words=50_000, slice_bytes=500_000
    )
    return bin_slack.pack(pieces, SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# The forest and the language model have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
