"""Nearest neighbours by inner product with a vantage-point tree per shard.

One extra coordinate, sqrt(M^2 - |x|^2) with M a shard's largest norm, turns
"largest inner product" into "smallest Euclidean distance" from (q, 0), where
the triangle inequality holds. Each shard of the vectors gets a tree that
splits its points at the median distance from a vantage point. A search
leaves out a side whose every point is, by that inequality, farther than the
k-th best so far; ``relax`` divides the distance such a side may still have,
so a factor above one leaves out more, and one is the exact search.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, named
from strata_engine.session import fits_broadcast, materialize

LEAF = 512


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector (array<double>), dim of the rows that take part: an id, no
    null or non-finite component, and not all zero. Vectors of different
    dimensions have no inner product, so each dimension is searched by itself."""
    src = named(vectors, id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    big = float(np.finfo(np.float64).max)
    src = src.where(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big))
        & F.exists("vector", lambda x: x != 0)
    )
    return src.select(F.col("id").cast("bigint").alias("id"), "vector", F.size("vector").alias("dim"))


def _down(vectors: np.ndarray, axis: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(vectors scaled to components of at most 1, the power of two that was
    taken out): squares and sums of the scaled ones cannot overflow."""
    most = np.abs(vectors).max(axis=axis, keepdims=True) if vectors.size else np.ones((1,) * vectors.ndim)
    exponent = np.frexp(most)[1]
    return np.ldexp(vectors, -exponent), exponent


def _scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner product of each row with the same row of ``points``, summed from
    the first component to the last in double precision (so it may overflow,
    and equal vectors get equal scores)."""
    total = np.zeros(len(queries))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(queries.shape[1]):
            total += queries[:, j] * points[:, j]
    return total


class Tree:
    """Vantage-point tree in arrays. Node i has a vantage point ``pivot[i]``,
    a radius and two children, or (radius < 0) the range low..high of
    ``order``. Distances are those of the points scaled down, ``scaled``;
    scores are taken from the points as they are."""

    def __init__(self, ids, points, scaled, extra, pivot, radius, inner, outer, low, high, order):
        self.ids, self.points, self.scaled, self.extra = ids, points, scaled, extra
        self.pivot, self.radius, self.inner, self.outer = pivot, radius, inner, outer
        self.low, self.high, self.order = low, high, order

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray, seed: int = 11) -> Tree:
        by_id = np.argsort(ids, kind="stable")
        ids, points = ids[by_id], points[by_id]
        scaled, extra = cls._space(points)
        rng = np.random.default_rng(seed)
        order = np.arange(len(ids))
        pivot, radius, inner, outer, low, high = [], [], [], [], [], []

        def node(a, b):
            for values, v in ((pivot, -1), (radius, -1.0), (inner, -1), (outer, -1), (low, a), (high, b)):
                values.append(v)
            return len(pivot) - 1

        todo = [node(0, len(ids))] if len(ids) else []
        while todo:
            i = todo.pop()
            a, b = low[i], high[i]
            if b - a <= LEAF:
                continue
            held = order[a:b]
            p = int(held[rng.integers(len(held))])
            away = np.sqrt(((scaled[held] - scaled[p]) ** 2).sum(1) + (extra[held] - extra[p]) ** 2)
            middle = float(np.median(away))
            near = away <= middle
            if near.all():  # copies of one vector, or ties at the median: try the strict side
                near = away < middle
                if not near.any():
                    continue
                middle = float(away[near].max())
            if not 0 < near.sum() < len(held):  # a child is always smaller
                continue
            order[a:b] = np.concatenate([held[near], held[~near]])
            cut = a + int(near.sum())
            pivot[i], radius[i] = p, middle
            inner[i], outer[i] = node(a, cut), node(cut, b)
            todo += [inner[i], outer[i]]
        as_ints = [np.array(v, np.int64) for v in (pivot, inner, outer, low, high)]
        return cls(ids, points, scaled, extra, as_ints[0], np.array(radius, float), *as_ints[1:], order)

    @staticmethod
    def _space(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(points scaled down, their extra coordinate)."""
        scaled, _ = _down(points, None)
        norm2 = np.einsum("pd,pd->p", scaled, scaled)
        return scaled, np.sqrt(np.maximum(norm2.max(initial=0.0) * (1 + 1e-12) - norm2, 0.0))

    def dump(self) -> bytes:
        """Without what follows from the points: half the bytes to shuffle."""
        out = io.BytesIO()
        np.savez(out, **{k: v for k, v in vars(self).items() if k not in ("scaled", "extra")})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            scaled, extra = cls._space(held["points"])
            return cls(scaled=scaled, extra=extra, **{k: held[k] for k in held.files})

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, is there one) of the k best for every query, nearest
        first, ties to the smaller id, scores that overflow to no number
        last; a query's own id is left out. Queries walk the tree together,
        each skipping what its own bound rules out."""
        n = len(queries)
        best_id = np.full((n, k), -1, np.int64)
        best = np.full((n, k), np.nan)
        near = np.full((n, k), -np.inf)  # the same, of the scaled vectors; -inf: no neighbour yet
        if not len(self.ids):
            return best_id, best, near > -np.inf
        small, _ = _down(queries, 1)
        q2 = np.einsum("qd,qd->q", small, small)
        top2 = float((np.einsum("pd,pd->p", self.scaled, self.scaled) + self.extra**2).max())
        slack = 1e-9 * (1.0 + q2 + top2)  # rounding must not cut off a tie

        def bound(rows):
            """Distance of the k-th best so far; infinite while there are fewer."""
            worst = near[rows].min(1)
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(q2[rows] + top2 - 2 * worst, 0.0)) + slack[rows])

        def leaf(i, rows):
            at = self.order[self.low[i] : self.high[i]]
            # a matrix product finds what may be among the best, up to its rounding
            rough = small[rows] @ self.scaled[at].T
            possible = rough >= (near[rows].min(1) - slack[rows])[:, None]
            possible &= self.ids[at][None, :] != query_ids[rows][:, None]
            r, c = np.nonzero(possible)
            if not len(r):
                return
            close = rough[r, c]
            r, c = rows[r], at[c]
            touched = np.unique(r)
            who = np.concatenate([np.repeat(touched, k), r])
            score = np.concatenate([best[touched].ravel(), _scores(queries[r], self.points[c])])
            ids = np.concatenate([best_id[touched].ravel(), self.ids[c]])
            close = np.concatenate([near[touched].ravel(), close])
            # places without a neighbour come last, before them undefined scores
            order = np.lexsort((ids, -np.where(np.isnan(score), -np.inf, score), np.isnan(score), np.isinf(close), who))
            who, score, ids, close = who[order], score[order], ids[order], close[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            first = place < k
            best[who[first], place[first]] = score[first]
            best_id[who[first], place[first]] = ids[first]
            near[who[first], place[first]] = close[first]

        # (node, its queries, least distance a point below it can have from each)
        todo = [(0, np.arange(n), np.zeros(n))]
        while todo:
            i, rows, least = todo.pop()
            keep = least * relax <= bound(rows)
            rows, least = rows[keep], least[keep]
            if not len(rows):
                continue
            if self.radius[i] < 0:
                leaf(i, rows)
                continue
            p, r = self.pivot[i], self.radius[i]
            away = np.sqrt(((small[rows] - self.scaled[p]) ** 2).sum(1) + self.extra[p] ** 2)
            inside = away <= r
            in_least, out_least = np.maximum(least, away - r), np.maximum(least, r - away)
            # each query goes to its own side first: the last pushed is visited first
            todo.append((self.outer[i], rows[inside], out_least[inside]))
            todo.append((self.inner[i], rows[~inside], in_least[~inside]))
            todo.append((self.inner[i], rows[inside], least[inside]))
            todo.append((self.outer[i], rows[~inside], least[~inside]))
        return best_id, best, near > -np.inf


def build_trees(points: DataFrame, shard_rows: int) -> DataFrame:
    """One row per shard: dim, shards (of that dimension), shard, tree. Ids
    are hashed to shards of about ``shard_rows`` points."""
    sizes = points.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    sizes = materialize(sizes, "vp-sizes")
    sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    schema = "dim int, shards int, shard int, tree binary"
    target = arrow_schema(schema)

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        tree = Tree.build(ids, flat.reshape(len(ids), -1)).dump()
        return pa.table([pa.array([v.as_py()], pa.int32()) for v in key] + [pa.array([tree], pa.binary())], schema=target)

    sharded = points.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.col("shards")).cast("int"))
    return sharded.select("dim", "shards", "shard", "id", "vector").groupBy("dim", "shards", "shard").applyInArrow(build, schema)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    relax: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 16_384,
    task_queries: int = 1_024,
    block_rows: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of ``vectors`` with the
    largest inner product for each row of ``queries`` (same columns), other
    than that id itself; fewer if there are fewer of its dimension. ``relax``
    1.0 is exact. Ids must be integers. Unusable vectors (see ``usable``) are
    neither queries nor candidates; repeated rows are candidates each, a
    query id with several vectors asks with the smallest; ties go to the
    smaller id. A score is the inner product in double precision as it comes
    out, infinite where it overflows; where that gives no number it ranks
    last.

    A task holds one shard's tree and about ``task_queries`` queries of its
    dimension, which walk the tree ``block_rows`` at a time: as many tasks as
    shards times parts of the queries."""
    points = materialize(usable(vectors, id_col, vector_col), "vp-points")
    trees = materialize(build_trees(points, shard_rows), "vp-trees")
    asked = usable(queries, id_col, vector_col).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("q"))
    asked = materialize(asked.select("id", "q.dim", "q.vector"), "vp-queries")
    parts = max(1, -(-asked.count() // task_queries))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    # one row per dimension: so many shards its queries have to meet
    shards = trees.select("dim", "shards").distinct()
    shards = F.broadcast(shards) if fits_broadcast(shards) else shards
    asked = asked.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    held = trees.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "tree")
    schema = "query_id bigint, vec_id bigint, score double"
    target = arrow_schema(schema)

    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        if not len(queries) or not len(trees):
            return target.empty_table()
        tree = Tree.load(trees.column("tree")[0].as_py())
        ids = queries.column("id").to_numpy()
        at = queries.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        out = []
        for i in range(0, len(ids), block_rows):
            found, scores, there = tree.search(ids[i : i + block_rows], at[i : i + block_rows], k, relax)
            out.append((np.repeat(ids[i : i + block_rows], there.sum(1)), found[there], scores[there]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=target)

    keys = ("dim", "shard", "part")
    left = asked.select(*keys, "id", "vector").groupBy(*keys)
    partial = left.cogroup(held.groupBy(*keys)).applyInArrow(run, schema)
    # NaN, Spark's largest value, ranks last
    order = Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
