"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than one chunk is cut into chunks that overlap. Each chunk is
pre-tokenised by itself, in parallel, from its own start, so near that start
its boundaries may be wrong. Two neighbours are stitched where boundaries of
both agree inside their overlap at the end of a word: no pre-token of the
pattern spans the step from a non-space to a space, so from there on both
chains are the true one, and what lies between two such cuts encodes as it
would inside the whole text. Neighbours that never agree (a run without
spaces longer than the overlap) are joined and encoded as one piece. The
pieces are encoded in parallel and put back in order. A text of one chunk is
its own piece and stays where it is. Decoding concatenates the bytes of the
ids.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, give_back, keeps, map_texts, named, slices
from strata_engine.session import fits_broadcast, materialize

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 1_024
# Rows decoded at once inside a task.
DECODE_ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    keeps("byte_bpe", _forget)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _forget() -> None:
    _encoding.cache_clear()
    _token_bytes.cache_clear()


def boundaries(chunk: str, pattern) -> list[int]:
    """Ends of the chunk's pre-tokens at which a word ends and a space
    follows, as offsets into it; the end of the chunk is not among them."""
    return [
        end
        for end in (m.end() for m in pattern.finditer(chunk))
        if end < len(chunk) and chunk[end].isspace() and not chunk[end - 1].isspace()
    ]


def _encode_map(df: DataFrame, keep: list[str], path: str, pattern: str) -> DataFrame:
    def make():
        encode = _encoding(path, pattern).encode_to_numpy  # there are no special tokens to allow
        return lambda texts: [[encode(t or "", disallowed_special=()).astype(np.int32) for t in texts]]

    return map_texts(df, keep, "text", "ids array<int>", make, owner="byte_bpe")


def _chunks(long_texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """row, doc_id, chunk, text of every chunk; each reaches ``overlap``
    characters into the next one."""
    schema = f"row bigint, doc_id {long_texts.schema['doc_id'].dataType.simpleString()}, chunk int, text string"
    target = arrow_schema(schema)

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                starts = [range(0, len(t), chunk_chars) for t in texts]
                index = pa.array([i for i, s in enumerate(starts) for _ in s], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(index),
                        part.column("doc_id").take(index).cast(target.field("doc_id").type),
                        pa.array([n for s in starts for n in range(len(s))], pa.int32()),
                        pa.array([t[a : a + chunk_chars + overlap] for t, s in zip(texts, starts) for a in s], pa.string()),
                    ],
                    schema=target,
                )

    return long_texts.select("row", "doc_id", "text").mapInArrow(cut, schema)


def _cut_points(chunks: DataFrame, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    """row, chunk, piece, parts, low, high: the range of its own text that a
    chunk gives to its piece, and how many chunks the piece is made of. Only
    boundaries inside overlaps are shuffled."""

    def make():
        import regex

        compiled = regex.compile(pattern)

        def f(texts):
            found = [boundaries(t, compiled) for t in texts]
            heads = [[p for p in b if p < overlap] for b in found]
            tails = [[p - chunk_chars for p in b if p >= chunk_chars] for b in found]
            return [heads, tails, list(map(len, texts))]

        return f

    marks = map_texts(chunks, ["row", "chunk"], "text", "head array<int>, tail array<int>, chars int", make)
    by_row = Window.partitionBy("row").orderBy("chunk")
    # the earliest place on which the chain from the left and the chunk's own agree
    cuts = marks.select(
        "row", "chunk", "chars", F.array_min(F.array_intersect("head", F.lag("tail").over(by_row))).alias("cut")
    )
    starts_piece = (F.col("chunk") == 0) | F.col("cut").isNotNull()
    is_last = F.lead("chunk").over(by_row).isNull()
    next_cut = F.lead("cut").over(by_row)
    ranges = cuts.select(
        "row",
        "chunk",
        F.sum(starts_piece.cast("int")).over(by_row).alias("piece"),
        F.coalesce("cut", F.lit(0)).alias("low"),
        F.when(is_last, F.col("chars")).otherwise(F.lit(chunk_chars) + F.coalesce(next_cut, F.lit(0))).alias("high"),
    )
    return ranges.withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy("row", "piece")))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, ids (array<int>): the ids of every whole text by the rank file
    at ``path`` (a path every executor has), each match of ``pattern`` merged
    by itself, no special tokens. Null and empty texts have no ids; null ids
    and repeated rows give a row each; other columns are ignored."""
    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    is_long = F.length("text") > chunk_chars
    whole = _encode_map(src.where(~is_long), ["doc_id"], path, pattern)

    # written once: the number given to a row must not change when a task is run again
    numbered = src.where(is_long).withColumn("row", F.monotonically_increasing_id())
    chunks = materialize(_chunks(numbered, chunk_chars, overlap), "bpe-chunks")
    ranges = materialize(_cut_points(chunks, pattern, chunk_chars, overlap), "bpe-cuts")
    # the chunks move only where the list of cuts is too long to send along
    ranges = F.broadcast(ranges) if fits_broadcast(ranges) else ranges
    parts = chunks.join(ranges, ["row", "chunk"]).select(
        "row", "doc_id", "piece", "chunk", "parts", F.expr("substring(text, low + 1, high - low)").alias("text")
    )
    joined = (
        parts.where("parts > 1")
        .groupBy("row", "piece")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("held"))
        .select("row", "doc_id", "piece", F.concat_ws("", F.col("held.text")).alias("text"))
    )
    pieces = parts.where("parts = 1").select("row", "doc_id", "piece", "text").unionByName(joined)
    encoded = _encode_map(pieces, ["row", "doc_id", "piece"], path, pattern)
    stitched = encoded.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("held")
    )
    return whole.unionByName(stitched.select("doc_id", F.flatten("held.ids").alias("ids")))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and data (binary): the bytes of the ids, concatenated.
    Null ids decode to null; an id outside the vocabulary is an error."""
    src = named(encoded, doc_id=id_col, ids=ids_col)
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, data binary"
    target = arrow_schema(schema)

    def run(batches):
        table = _token_bytes(path)
        for batch in batches:
            for part in (batch.slice(at, DECODE_ROWS) for at in range(0, batch.num_rows, DECODE_ROWS)):
                data = [_bytes_of(part.column(1)[i], table) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(target.field("ids").type), pa.array(data, pa.binary())], schema=target
                )
        give_back()

    return src.mapInArrow(run, schema)


def _bytes_of(ids: pa.ListScalar, table: list[bytes]) -> bytes | None:
    return b"".join(map(table.__getitem__, ids.values.to_numpy(zero_copy_only=False).tolist())) if ids.is_valid else None
