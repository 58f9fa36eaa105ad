"""Substring deduplication by seed and extend.

Seeds: of every ``min_words``-word window the ``gram``-word piece with the
smallest hash is its anchor (winnowing), so equal windows have equal anchors
at equal places, and a text has about one anchor for seven words. Documents
are joined on the anchors that occur more than once.

Extension: an occurrence of such an anchor is extended both ways as far as a
window around it reaches. It is not compared with every other occurrence:
the windows are hashed, and among all occurrences of an anchor equal windows
meet by their hash, the earliest one (smallest id, then start) being the
original. A window that is not the original is a repeat; repeats that
overlap or touch along a text merge to maximal repeats, none shorter than
``min_words``, and those are removed.

Copies of one word sequence need no windows: all of a copy is a repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, begin, give_back, named, slices, small_batches, text_bytes
from strata_engine.llm.packed import by_bucket, shared_here, shared_of_all, split_hits, spread, unpack
from strata_engine.session import fits_broadcast, materialize

MIN_WORDS = 20
GRAM = 8
BUCKET_ENTRIES = 500_000
SEGMENT_ENTRIES = 400_000
# Documents gathered at most before they are sent off (short ones have no entries).
SEGMENT_ROWS = 50_000
MAX_CACHED_WORDS = 100_000

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xC2B2AE3D27D4EB4F)


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k word hashes."""
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * _K
        out ^= out >> np.uint64(29)
    out *= _M
    return out ^ (out >> np.uint64(32))


class Windows:
    """Anchors and window hashes of texts; word hashes are kept."""

    def __init__(self, min_words: int, gram: int):
        self.min_words, self.gram = min_words, gram
        self.cache: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        cache, digest = self.cache, xxhash.xxh3_64_intdigest
        if len(cache) > MAX_CACHED_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = digest(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

    def anchors(self, h: np.ndarray) -> np.ndarray:
        """The anchor hash of every window (empty if the text is too short)."""
        if len(h) < self.min_words:
            return np.zeros(0, np.uint64)
        return np.lib.stride_tricks.sliding_window_view(_grams(h, self.gram), self.min_words - self.gram + 1).min(1)

    def windows(self, h: np.ndarray) -> np.ndarray:
        return _grams(h, self.min_words)


def digest_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _owner(fp: bytes) -> int:
    return int.from_bytes(fp[:8], "little", signed=True)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _table(schema: pa.Schema, columns) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _by_owner(replies: DataFrame, kind, out: str) -> DataFrame:
    """Rows (owner, values) from the replies to each segment."""
    target = arrow_schema(out)

    def run(_, rows):
        give_back()
        return _table(target, spread(unpack(rows.column("owners"), np.int64), unpack(rows.column("values"), kind)))

    replies = replies.where(F.length("owners") > 0).select("segment", "owners", "values")
    return replies.groupBy("segment").applyInArrow(run, out)


def _seeds(docs: DataFrame, min_words: int, gram: int, buckets: int) -> DataFrame:
    """owner, id, n_words, fp, anchors (binary): a row per document with the
    repeated anchors that its own task knows of, and rows with n_words null:
    packed replies (segment, owners, values) that add those found elsewhere.
    Documents of equal word sequences have one owner number and do not count
    as repeats of one another."""
    schema = "bucket int, segment bigint, owner bigint, id bigint, n_words bigint, fp binary, anchors binary, owners binary"
    target = arrow_schema(schema)

    def emit(ids, ns, fps, parts):
        index = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        numbers = np.array([_owner(fp) for fp in fps], np.int64)
        distinct, owner, repeated = shared_here(keys, numbers[index])
        ends = np.cumsum([len(p) for p in parts])
        mine = [p[r].tobytes() for p, r in zip(parts, np.split(repeated, ends[:-1]))]
        yield _batch(target, bucket=(numbers % buckets).tolist(), owner=numbers, id=ids, n_words=ns, fp=fps, anchors=mine)
        for b, (k, o) in by_bucket(distinct, buckets, owner):
            yield _batch(target, bucket=[b], segment=numbers[:1], anchors=[k], owners=[o])

    def run(batches):
        begin("seed_extend")
        tool = Windows(min_words, gram)
        ids, ns, fps, parts, held, seen = [], [], [], [], 0, set()
        for batch in batches:
            for part in slices(batch, "text"):
                for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    words = (text or b"").split()
                    fp = digest_of(words)
                    # one of several copies in a task shows their anchors
                    new = fp not in seen
                    seen.add(fp)
                    found = np.unique(tool.anchors(tool.hashes(words))) if new else np.zeros(0, np.uint64)
                    if new and len(words) >= min_words:
                        found = _with_repeats(found, tool, words)
                    ids.append(i)
                    ns.append(len(words))
                    fps.append(fp)
                    parts.append(found)
                    held += len(found)
                if held > SEGMENT_ENTRIES or len(ids) > SEGMENT_ROWS:
                    yield from emit(ids, ns, fps, parts)
                    ids, ns, fps, parts, held, seen = [], [], [], [], 0, set()
        if ids:
            yield from emit(ids, ns, fps, parts)
        give_back()

    out = "owner bigint, id bigint, n_words bigint, fp binary, anchors binary, segment bigint, owners binary, values binary"
    out_target = arrow_schema(out)

    def join(_, rows):
        documents = rows.filter(rows.column("n_words").is_valid()).select(["owner", "id", "n_words", "fp", "anchors"])
        entries = rows.filter(rows.column("n_words").is_null())
        keys, owners = unpack(entries.column("anchors"), np.uint64), unpack(entries.column("owners"), np.int64)
        hit = shared_of_all(keys, owners)
        found_owners, found_keys = split_hits(entries, "anchors", hit, owners, keys)
        found = _batch(out_target, segment=entries.column("segment").combine_chunks(), owners=found_owners, values=found_keys)
        documents = _batch(out_target, **{c: documents.column(c).combine_chunks() for c in documents.column_names})
        give_back()
        return pa.Table.from_batches([documents, found])

    return docs.select("id", "text").mapInArrow(run, schema).groupBy("bucket").applyInArrow(join, out)


def _with_repeats(found: np.ndarray, tool: Windows, words: list[bytes]) -> np.ndarray:
    """The anchors once each, and twice those that occur at several places of
    the text itself, so that they count as repeated."""
    grams = _grams(tool.hashes(words), tool.gram)
    values, counts = np.unique(grams, return_counts=True)
    return np.concatenate([found, np.intersect1d(found, values[counts >= 2], assume_unique=True)])


def _extensions(seeded: DataFrame, min_words: int, gram: int, buckets: int) -> DataFrame:
    """id, starts (binary int32): windows with a repeated anchor that also
    start earlier. ``seeded`` has id, fp, text and held (its repeated
    anchors, in byte strings)."""
    schema = "bucket int, segment bigint, id bigint, starts binary, keys binary, checks binary, owners binary"
    target = arrow_schema(schema)
    out = "id bigint, starts binary, segment bigint, owners binary, values binary"
    out_target = arrow_schema(out)

    def later(keys, checks, owners, starts):
        """Which entries have an equal window that starts earlier."""
        if not len(keys):
            return np.zeros(0, bool)
        order = np.lexsort((starts, owners, checks, keys))
        k, c, o, s = keys[order], checks[order], owners[order], starts[order]
        new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        late = np.zeros(len(k), bool)
        late[order] = (o != o[first]) | (s != s[first])  # an alike row is not later
        return late

    def emit(parts):
        keys, checks, owners, starts = (np.concatenate(x) for x in zip(*parts))
        late = later(keys, checks, owners, starts)
        ids, held = spread(owners[late], starts[late])
        if len(ids):
            yield _batch(target, bucket=[int(i) % buckets for i in ids], id=ids, starts=held)
        first = ~late
        # dealt by the window's own hash: only equal windows have to meet, and
        # the windows of a common anchor are many
        for b, (k, c, o, s) in by_bucket(keys[first], buckets, checks[first], owners[first], starts[first]):
            yield _batch(target, bucket=[b], segment=owners[:1], keys=[k], checks=[c], owners=[o], starts=[s])

    def run(batches):
        begin("seed_extend")
        tool = Windows(min_words, gram)
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                columns = [part.column(c).to_pylist() for c in ("id", "fp", "text", "held")]
                for i, fp, text, wanted in zip(*columns):
                    words = (text or b"").split()
                    if len(words) < min_words or digest_of(words) != fp:
                        continue
                    h = tool.hashes(words)
                    anchors = tool.anchors(h)
                    at = np.flatnonzero(np.isin(anchors, np.frombuffer(b"".join(wanted), np.uint64)))
                    if not len(at):
                        continue
                    checks = (anchors[at] >> np.uint64(32)).astype(np.uint32)
                    parts.append((tool.windows(h)[at], checks, np.full(len(at), i, np.int64), at.astype(np.int32)))
                    held += len(at)
                if held > SEGMENT_ENTRIES:
                    yield from emit(parts)
                    parts, held = [], 0
        if parts:
            yield from emit(parts)
        give_back()

    def settle(_, rows):
        known = rows.filter(rows.column("id").is_valid()).select(["id", "starts"])
        entries = rows.filter(rows.column("id").is_null())
        kinds = (("keys", np.uint64), ("checks", np.uint32), ("owners", np.int64), ("starts", np.int32))
        keys, checks, owners, starts = (unpack(entries.column(c), kind) for c, kind in kinds)
        late = later(keys, checks, owners, starts)
        found_owners, found_starts = split_hits(entries, "keys", late, owners, starts)
        found = _batch(out_target, segment=entries.column("segment").combine_chunks(), owners=found_owners, values=found_starts)
        known = _batch(out_target, **{c: known.column(c).combine_chunks() for c in known.column_names})
        give_back()
        return pa.Table.from_batches([known, found])

    made = seeded.select("id", "fp", "text", "held").mapInArrow(run, schema).groupBy("bucket").applyInArrow(settle, out)
    made = materialize(made, "seed-windows")
    elsewhere = _by_owner(made.where("segment is not null"), np.int32, "id bigint, starts binary")
    return made.where("segment is null").select("id", "starts").unionByName(elsewhere)


def _merge(starts: np.ndarray, min_words: int) -> tuple[list[int], list[int]]:
    """Maximal repeats (first word, word after the last) of repeated windows."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > min_words)
    return starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + min_words).tolist()


def _spans_of(windows: DataFrame, min_words: int) -> DataFrame:
    """id, low, high (arrays): the maximal repeats of every document."""
    schema = "id bigint, low array<int>, high array<int>"
    target = arrow_schema(schema)
    grouped = windows.groupBy("id").agg(F.collect_list("starts").alias("held"))

    def run(batches):
        for batch in batches:
            merged = [_merge(np.concatenate([np.frombuffer(x, np.int32) for x in held]), min_words) for held in batch.column("held").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([m[0] for m in merged], target.field("low").type), pa.array([m[1] for m in merged], target.field("high").type)],
                schema=target,
            )

    return grouped.mapInArrow(run, schema)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """id, fp, low, high: the maximal repeats of every document that has any;
    ``fp`` is the digest of the word sequence they belong to."""
    src = named(docs, id=id_col, text=text_col)
    src = src.select(F.col("id").cast("bigint").alias("id"), text_bytes("text").alias("text")).where("id is not null")
    # about an anchor for seven words of six bytes, a window for each word
    volume = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = materialize(_seeds(src, min_words, gram, int(max(8, volume // 40 // BUCKET_ENTRIES))), "seed-anchors")
    documents = found.where("n_words is not null")

    # a row per id, copies included; of rows with one id, the one with the smallest digest stands for it
    one = documents.groupBy("id").agg(F.min(F.struct("fp", "n_words", "owner")).alias("d")).select("id", "d.*")
    classes = one.groupBy("n_words", "fp", "owner").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    repeated = materialize(classes.where(f"copies > 1 and n_words >= {min_words}"), "seed-classes")
    copies = one.join(_small(repeated.drop("owner")), ["n_words", "fp"]).where("id <> rep")
    copies = copies.select("id", "fp", F.array(F.lit(0)).alias("low"), F.array(F.col("n_words").cast("int")).alias("high"))
    copies = materialize(copies, "seed-copies")

    elsewhere = _by_owner(found.where("segment is not null"), np.uint64, "owner bigint, anchors binary")
    anchors = found.where(F.length("anchors") > 0).select("owner", "anchors").unionByName(elsewhere)
    anchors = anchors.groupBy("owner").agg(F.collect_list("anchors").alias("held"))
    # of copies only the first has windows that matter
    seeded = anchors.join(classes, "owner").select("rep", "fp", "held").withColumnRenamed("rep", "id")
    seeded = materialize(seeded, "seed-joined")
    texts = src.join(_small(seeded.select("id")), "id", "left_semi")  # only texts with a seed move
    windows = _extensions(texts.join(seeded, "id"), min_words, gram, int(max(8, volume // 24 // BUCKET_ENTRIES)))
    spans = _spans_of(windows, min_words).join(one.select("id", "fp"), "id").select("id", "fp", "low", "high")
    return materialize(spans.unionByName(copies), "seed-spans")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    gram: int = GRAM,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (array of struct low, high: the
    removed word ranges), kept (the other words joined by one space), a row
    for every row of ``docs``; ``carry`` names columns of ``docs`` to hand on
    in a struct ``carried``.

    A word is removed if a window of ``min_words`` words covers it whose
    word sequence also starts earlier: in a smaller id, or earlier in the
    same document. Windows are judged on the input. Ids must be integers.
    Null and empty texts have no words; a row with a null id is returned
    whole and repeats nothing; of rows with one id but different texts, one
    (of the smallest digest) is compared, the others are returned whole;
    alike rows get the same. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    spans = repeats(docs, id_col, text_col, min_words, gram)
    carried = F.struct(*[docs[f"`{c}`"].alias(c) for c in carry] or [F.lit(None).cast("int").alias("none")])
    src = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"), carried.alias("carried"))
    src = src.withColumn("text", text_bytes("text"))
    src = src.join(_small(spans.withColumnRenamed("id", "doc_id")), "doc_id", "left")
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<low:int,high:int>>, kept string"
    if carry:
        schema += f", carried {src.schema['carried'].dataType.simpleString()}"
    target = arrow_schema(schema)
    with_carried = bool(carry)

    def apply(text, fp, low, high):
        words = (text or b"").split()
        if low is None or digest_of(words) != fp:
            return len(words), 0, [], b" ".join(words)
        kept, at = [], 0
        for a, b in zip(low, high):
            kept += words[at:a]
            at = b
        kept += words[at:]
        return len(words), len(words) - len(kept), [{"low": a, "high": b} for a, b in zip(low, high)], b" ".join(kept)

    def run(batches):
        begin("seed_extend")
        for batch in batches:
            for part in slices(batch, "text"):
                rows = list(map(apply, *(part.column(c).to_pylist() for c in ("text", "fp", "low", "high"))))
                made = list(zip(*rows)) or [[]] * 4
                columns = [pa.array(v, f.type) for v, f in zip(made[:3], list(target)[1:4])]
                columns = [part.column("doc_id").cast(target.field(0).type), *columns, pa.array(made[3], pa.binary()).cast(pa.string())]
                if with_carried:
                    columns.append(part.column("carried").cast(target.field("carried").type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)
            give_back()

    return src.mapInArrow(run, schema)
