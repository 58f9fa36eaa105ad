"""Similarity join of documents on word shingles by a token-group matrix.

A document is the set of its distinct shingles. Sets equal to one another
are one class. For the others, in this order, each step exact and each linear
in the shingles it reads:

1. A token (shingle) held by no other set cannot be in an intersection. Of a
   fixed share of each set's tokens (those with the smallest hashes) at least
   a known number must be shared if the set has any partner. Sets without are
   out, and few others remain.
2. The same for all tokens of the remaining sets. What is left of a set is
   its shared tokens, rarest first; a partner must agree on one of the first
   few of them (its prefix).
3. Groups: for every prefix token, the set with the largest shared part is
   compared with the others; what links becomes one group of similar sets.
4. The matrix: for every prefix token the groups that hold it, with the
   bounds of their sizes. A set looks up the other groups on its prefix; a
   group whose sizes or whose token union cannot give the overlap stays
   closed. Only sets of the qualifying groups are compared, one link being
   enough to join two groups.

Copies and groups are never expanded to pairs. Work per token is
pre-aggregated in each task, so a token of a third of all documents is one
entry per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, begin, give_back, named, slices, text_bytes
from strata_engine.llm.components import connected
from strata_engine.llm.packed import by_bucket, shared_here, shared_of_all, split_hits, unpack
from strata_engine.session import fits_broadcast, materialize

# Tokens that one bucket of the shared-token count holds about.
BUCKET_TOKENS = 500_000
# Tokens that a task gathers before it sends them off.
SEGMENT_TOKENS = 600_000
# Documents gathered at most before they are sent off (those without words have no tokens).
SEGMENT_ROWS = 50_000
MAX_CACHED_WORDS = 100_000

# Sets that ask a group, and members of the group, that meet in one task.
ASKING_BLOCK = 512
MEMBER_BLOCK = 2_048
# Owner of the tokens of a document without id.
NOBODY = -1

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Distinct 64-bit shingle hashes of texts; word hashes are kept."""

    def __init__(self, words: int):
        self.words = words
        self.cache: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        cache, digest = self.cache, xxhash.xxh3_64_intdigest
        if len(cache) > MAX_CACHED_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = digest(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

    def tokens(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct shingles; a text of fewer words is one shingle,
        one without words has none. A-Z count as a-z."""
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = self._hashes(words)
        k = min(self.words, len(words))
        n = len(words) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = (out ^ h[i : i + n]) * _K
            out ^= out >> np.uint64(29)
        out *= _M
        out ^= out >> np.uint64(32)
        return np.unique(out)


def needed(n: np.ndarray | int, percent: int):
    """Least overlap of a set of n with a partner: their union has n at least."""
    return -(-percent * n // 100)


def _sketch(docs: DataFrame, words: int, percent: int, share: int, buckets: int) -> DataFrame:
    """Step 1 per document: id, n, fp (digest of the set), short (how many
    more shared tokens it needs among every ``share``-th part of its tokens);
    rows of kind 1 are (segment, bucket, tokens, owners) for the count."""
    schema = "kind int, segment bigint, bucket int, id bigint, n bigint, fp binary, short bigint, tokens binary, owners binary"
    target = arrow_schema(schema)

    def batch_of(**columns):
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in target], schema=target
        )

    def emit(ids, ns, fps, shorts, parts):
        index = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        owners = np.array([NOBODY if i is None else i for i in ids], np.int64)[index]
        distinct, owner, repeated = shared_here(np.concatenate(parts), owners)
        # shared inside this task: counted here, one ownerless entry tells the others
        here = np.bincount(index, repeated, len(parts)).astype(np.int64)
        yield batch_of(kind=[0] * len(ids), id=ids, n=ns, fp=fps, short=[s - int(c) for s, c in zip(shorts, here)])
        for bucket, (t, o) in by_bucket(distinct, buckets, owner):
            yield batch_of(kind=[1], segment=ids[:1], bucket=[bucket], tokens=[t], owners=[o])

    def run(batches):
        begin("group_join")
        shingler = Shingler(words)
        ids, ns, fps, shorts, parts, held = [], [], [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    t = shingler.tokens(text)
                    some = t[: -(-len(t) // share)]  # the smallest hashes
                    ids.append(i)
                    ns.append(len(t))
                    fps.append(xxhash.xxh3_128_digest(t.tobytes()))
                    shorts.append(int(needed(len(t), percent)) - (len(t) - len(some)))
                    parts.append(some)
                    held += len(some)
                if held > SEGMENT_TOKENS or len(ids) > SEGMENT_ROWS:
                    yield from emit(ids, ns, fps, shorts, parts)
                    ids, ns, fps, shorts, parts, held = [], [], [], [], [], 0
        if ids:
            yield from emit(ids, ns, fps, shorts, parts)
        give_back()

    return docs.select("id", "text").mapInArrow(run, schema)


def _count_shared(packed: DataFrame) -> DataFrame:
    """id, shared: how many entries of each owner are tokens that some other
    document (of another task, or several of one) holds as well."""
    schema = "segment bigint, owners binary"
    target = arrow_schema(schema)

    def find(_, rows):
        tokens, owners = unpack(rows.column("tokens"), np.uint64), unpack(rows.column("owners"), np.int64)
        hit = shared_of_all(tokens, owners) & (owners != NOBODY)
        (found,) = split_hits(rows, "tokens", hit, owners)
        give_back()
        return pa.table([rows.column("segment").combine_chunks(), pa.array(found, pa.binary())], schema=target)

    out = "id bigint, shared bigint"
    out_target = arrow_schema(out)

    def count(_, rows):
        ids, n = np.unique(unpack(rows.column("owners"), np.int64), return_counts=True)
        return pa.table([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], schema=out_target)

    found = packed.select("bucket", "segment", "tokens", "owners").groupBy("bucket").applyInArrow(find, schema)
    return found.where(F.length("owners") > 0).groupBy("segment").applyInArrow(count, out)


def _segments(docs: DataFrame, words: int, buckets: int) -> DataFrame:
    """Rows of kind 0: the whole sets of a bounded segment of documents
    (ids, sizes, tokens); of kind 1: per bucket the distinct tokens of a
    segment and how many of its sets hold each."""
    schema = "kind int, segment string, bucket int, ids array<bigint>, sizes array<int>, tokens binary, holders binary"
    target = arrow_schema(schema)

    def batch_of(**columns):
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in target], schema=target
        )

    def emit(segment, ids, parts):
        tokens = np.concatenate(parts)
        yield batch_of(kind=[0], segment=[segment], ids=[ids], sizes=[[len(p) for p in parts]], tokens=[tokens.tobytes()])
        distinct, counts = np.unique(tokens, return_counts=True)
        for bucket, (t, n) in by_bucket(distinct, buckets, counts.astype(np.int64)):
            yield batch_of(kind=[1], segment=[segment], bucket=[bucket], tokens=[t], holders=[n])

    def run(batches):
        begin("group_join")
        shingler = Shingler(words)
        segment, ids, parts, held = "", [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    if not ids:
                        segment = f"{i}:{xxhash.xxh3_128_hexdigest(text or b'')}"
                    ids.append(i)
                    parts.append(shingler.tokens(text))
                    held += len(parts[-1])
                    if held > SEGMENT_TOKENS:
                        yield from emit(segment, ids, parts)
                        ids, parts, held = [], [], 0
        if ids:
            yield from emit(segment, ids, parts)
        give_back()

    return docs.select("id", "text").mapInArrow(run, schema)


def _shared_sets(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """Step 2: id, n, tokens (those that another set holds too, rarest
    first) of the sets that share enough. Tokens are counted per bucket, and
    each segment gets back the counts of its own."""
    packed = materialize(_segments(docs, words, buckets), "join-segments")
    schema = "segment string, tokens binary, holders binary"
    target = arrow_schema(schema)

    def total(_, rows):
        tokens, holders = unpack(rows.column("tokens"), np.uint64), unpack(rows.column("holders"), np.int64)
        _, inverse = np.unique(tokens, return_inverse=True)
        every = np.bincount(inverse, holders).astype(np.int64)[inverse]
        kept = split_hits(rows, "tokens", every >= 2, tokens, every)
        give_back()
        return pa.table([rows.column("segment").combine_chunks(), *(pa.array(k, pa.binary()) for k in kept)], schema=target)

    out = "id bigint, n bigint, tokens array<bigint>"
    out_target = arrow_schema(out)

    def finish(_, sets, counts):
        tokens, holders = unpack(counts.column("tokens"), np.uint64), unpack(counts.column("holders"), np.int64)
        tokens, first = np.unique(tokens, return_index=True)
        holders = holders[first]
        ids, ns, kept = [], [], []
        for row_ids, sizes, data in zip(*(sets.column(c).to_pylist() for c in ("ids", "sizes", "tokens"))):
            ends = np.cumsum(sizes)[:-1]
            for i, own in zip(row_ids, np.split(np.frombuffer(data, np.uint64), ends)):
                at = np.searchsorted(tokens, own)
                known = np.flatnonzero(tokens[np.minimum(at, len(tokens) - 1)] == own) if len(tokens) else []
                if len(own) and len(known) >= needed(len(own), percent):
                    shared = own[known]
                    ids.append(i)
                    ns.append(len(own))
                    kept.append(shared[np.lexsort((shared, holders[at[known]]))].view(np.int64))
        made = pa.table([pa.array(c, f.type) for c, f in zip((ids, ns, kept), out_target)], schema=out_target)
        del ids, ns, kept
        give_back()
        return made

    counts = packed.where("kind = 1").select("bucket", "segment", "tokens", "holders").groupBy("bucket").applyInArrow(total, schema)
    sets = packed.where("kind = 0").select("segment", "ids", "sizes", "tokens")
    return sets.groupBy("segment").cogroup(counts.groupBy("segment")).applyInArrow(finish, out)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are at least ``percent`` similar."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b")).cast("bigint")
    return (
        pairs.join(left, "a").join(right, "b")
        .where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))
        .select("a", "b")
    )


def _may_link(c, n, other_n, percent: int):
    """c shared tokens of a set of n can give the overlap with one of other_n."""
    return (100 + percent) * c >= percent * (n + other_n)


def link_sets(sets: DataFrame, percent: int) -> DataFrame:
    """Steps 3 and 4 on ``sets`` (id, n, tokens: shared tokens, rarest
    first): links (a, b) with the components of all links among them."""
    # shared tokens less what any partner must overlap, plus one
    first = F.expr(f"slice(tokens, 1, int(size(tokens) - ({percent} * n + 99) div 100 + 1))")
    prefix = sets.select("id", "n", F.size("tokens").cast("bigint").alias("c"), F.explode(first).alias("token"))
    prefix = materialize(prefix, "join-prefix")

    # 3. groups around the set with the largest shared part
    best = F.max(F.struct((F.col("c") / F.col("n")).alias("part"), (-F.col("id")).alias("low"), "n", "c"))
    heads = prefix.groupBy("token").agg(best.alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    heads = heads.select("token", (-F.col("head.low")).alias("a"), F.col("head.n").alias("n_a"), F.col("head.c").alias("c_a"))
    near = prefix.join(heads, "token").where(
        (F.col("id") != F.col("a"))
        & _may_link(F.col("c"), F.col("n"), F.col("n_a"), percent)
        & _may_link(F.col("c_a"), F.col("n_a"), F.col("n"), percent)
    )
    star = materialize(_linked(near.select("a", F.col("id").alias("b")).distinct(), sets, percent), "join-star")
    groups = connected(star)

    # 4. the matrix of prefix tokens and groups
    placed = prefix.join(groups, "id", "left").withColumn("g", F.coalesce("component", "id")).drop("component")
    sizes = groups.groupBy(F.col("component").alias("g")).agg(F.count(F.lit(1)).alias("members"))
    placed = placed.join(sizes, "g", "left").withColumn("members", F.coalesce("members", F.lit(1)))
    placed = materialize(placed, "join-placed")
    matrix = placed.groupBy("token", F.col("g").alias("to_g")).agg(
        F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.max("c").alias("max_c"), F.first("members").alias("to_members")
    )
    crossed = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1").select("token")
    matrix = matrix.join(crossed, "token")
    asked = placed.join(crossed, "token", "left_semi").join(matrix, "token").where(
        # the smaller group asks the larger one
        (F.struct("members", "g") < F.struct("to_members", "to_g"))
        & (100 * F.col("max_n") >= percent * F.col("n"))
        & (100 * F.col("n") >= percent * F.col("min_n"))
        & _may_link(F.col("c"), F.col("n"), F.col("min_n"), percent)
        & _may_link(F.col("max_c"), F.col("min_n"), F.col("n"), percent)
    )
    asked = materialize(asked.select("id", "to_g", "to_members").distinct(), "join-asked")
    # a group of one is its token union: compared at once
    alone = asked.where("to_members = 1").select(F.col("id").alias("a"), F.col("to_g").alias("b"))
    opened = materialize(_qualifying(asked.where("to_members > 1"), sets, groups, percent), "join-opened")
    more = _linked(alone.distinct(), sets, percent).unionByName(_open(opened, sets, groups, percent))
    return materialize(star.unionByName(more), "join-links")


def _open(opened: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sets of ``opened`` (id, to_g) and members of
    those groups: blocks of the ones meet blocks of the others, and a set
    gives at most one link a block, which is enough to join the groups."""
    asking = opened.groupBy("to_g").agg(F.count(F.lit(1)).alias("n_asking"))
    held = groups.groupBy(F.col("component").alias("to_g")).agg(F.count(F.lit(1)).alias("n_held"))
    blocks = asking.join(held, "to_g").select(
        "to_g", F.ceil(F.col("n_asking") / ASKING_BLOCK).alias("ax"), F.ceil(F.col("n_held") / MEMBER_BLOCK).alias("mx")
    )
    blocks = materialize(blocks, "join-blocks")

    def dealt(rows, own, other, own_name, other_name):
        """Each row in its own block, once for every block of the others."""
        rows = rows.join(blocks, "to_g").withColumn(own_name, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        every = F.sequence(F.lit(0), F.col(other).cast("int") - 1)
        columns = ["to_g", "x", "y", "id", "n", "tokens"]
        # new columns for either side: both come from ``sets``
        return rows.withColumn(other_name, F.explode(every)).select(*[F.col(c).alias(c, metadata={"side": own}) for c in columns])

    xs = dealt(opened.join(sets, "id"), "ax", "mx", "x", "y")
    members = groups.select("id", F.col("component").alias("to_g")).join(sets, "id")
    ys = dealt(members, "mx", "ax", "y", "x")
    schema = "a bigint, b bigint"
    target = arrow_schema(schema)

    def match(_, left, right):
        found = _first_links(_sets_of(left), _sets_of(right), percent)
        return pa.table([pa.array(c, pa.int64()) for c in found], schema=target)

    keys = ("to_g", "x", "y")
    return xs.groupBy(*keys).cogroup(ys.groupBy(*keys)).applyInArrow(match, schema)


def _sets_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    tokens = [np.asarray(t, np.int64) for t in rows.column("tokens").to_pylist()]
    return rows.column("id").to_numpy(), rows.column("n").to_numpy(), tokens


def _first_links(left, right, percent: int) -> tuple[list[int], list[int]]:
    """For each set on the left the first similar one on the right, if any."""
    (ids, ns, sets), (other_ids, other_ns, others) = left, right
    if not len(ids):
        return [], []
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(t) for t in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    partner = np.full(len(ids), -1)
    for k, (i, n, t) in enumerate(zip(other_ids, other_ns, others)):
        low, high = np.searchsorted(tokens, t, "left"), np.searchsorted(tokens, t, "right")
        size = high - low
        at = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        both = np.bincount(owner[at], minlength=len(ids))
        partner[(partner < 0) & (ids != i) & (100 * both >= percent * (ns + n - both))] = k
    hit = partner >= 0
    return ids[hit].tolist(), other_ids[partner[hit]].tolist()


def _qualifying(asked: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The (id, to_g) whose token union overlaps the set enough."""
    wanted = asked.select(F.col("to_g").alias("g")).distinct()
    member = sets.join(groups, "id", "left").select(F.coalesce("component", "id").alias("g"), "tokens")
    union = member.join(wanted, "g", "left_semi").select(F.col("g").alias("to_g"), F.explode("tokens").alias("token")).distinct()
    own = asked.join(sets.select("id", "n", "tokens"), "id").select("id", "n", "to_g", F.explode("tokens").alias("token"))
    overlap = own.join(union, ["to_g", "token"]).groupBy("id", "to_g", "n").agg(F.count(F.lit(1)).alias("overlap"))
    return overlap.where(F.col("overlap") * 100 >= F.col("n") * percent).select("id", "to_g")


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    share: int = 4,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two documents link when 100 * intersection >= ``percent`` * union of
    their shingle sets; component_id is the smallest doc_id reachable by
    links. Ids must be integers. Null or empty texts have no shingles and
    link with nothing; a null id keeps its n_shingles and has a null
    component; rows with one id are one document with the links of all. An
    empty table gives no rows; other columns are ignored.
    """
    src = named(docs, id=id_col, text=text_col)
    src = src.select(F.col("id").cast("bigint").alias("id"), text_bytes("text").alias("text"))
    # about a token a word, six bytes a word
    volume = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(8, volume // 6 // share // BUCKET_TOKENS))
    sketch = materialize(_sketch(src, words, percent, share, buckets), "join-sketch")
    found = sketch.where("kind = 0").select("id", "n", "fp", "short")
    shared = _count_shared(sketch.where("kind = 1")).groupBy("id").agg(F.sum("shared").alias("shared"))

    classes = found.where("n > 0 and id is not null").groupBy("n", "fp").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("short").alias("short")
    )
    reps = classes.join(shared, F.col("rep") == F.col("id"), "left").where(F.coalesce("shared", F.lit(0)) >= F.col("short"))
    # a copy is no partner: only a set that shares with others too goes on
    reps = materialize(reps.select(F.col("rep").alias("id"), "n"), "join-reps")

    texts = src.join(F.broadcast(reps) if fits_broadcast(reps) else reps, "id", "left_semi")
    kept = reps.agg(F.sum("n")).first()[0] or 0
    sets = materialize(_shared_sets(texts, words, percent, int(max(8, kept // BUCKET_TOKENS))), "join-sets")
    component = connected(link_sets(sets, percent))

    repeated = classes.where("copies > 1").select("n", "fp", "rep")
    repeated = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    rows = found.select("id", "n", "fp").join(repeated, ["n", "fp"], "left").withColumn("rep", F.coalesce("rep", "id"))
    component = component.withColumnRenamed("id", "rep")
    component = F.broadcast(component) if fits_broadcast(component) else component
    rows = rows.join(component, "rep", "left")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"),
    )
