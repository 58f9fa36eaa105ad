"""Filter interaction audit: what every filter does in every order.

Which filter removes a document depends on the order they run in, but only
through the set of filters it fails, its mask. In an order (a permutation of
the filters, ranked by its Lehmer code) a document of mask m goes at step s
if the first s-1 filters are outside m and the s-th is inside. All orders
that begin with the same s filters have neighbouring ranks, so a mask's
removals at one step cover a few intervals of ranks. Documents are therefore
counted by part and mask; each mask's count is added where an interval
begins and taken off where it ends (a difference array over the ranks of a
step), and a running sum over the ranks gives every order's figures.

All of it is DataFrame work. The counts, at most 2^filters rows a part, are
all that meets the interval table, whose size depends on the number of
filters alone.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata_engine.llm.common import named
from strata_engine.session import materialize

# The interval table has up to 2^n times n! rows: beyond this it is no small table.
MOST_FILTERS = 6

WORD_GAP = r"[\x20\x09-\x0D]+"


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank of the lexicographically first permutation of 0..n-1 that begins
    with ``prefix``; the others follow it without a gap."""
    unused, rank = list(range(n)), 0
    for i, x in enumerate(prefix):
        rank += unused.index(x) * factorial(n - 1 - i)
        unused.remove(x)
    return rank


def rank_intervals(n: int) -> list[tuple[int, int, int, int, int, int]]:
    """The difference arrays of one document of each mask, as rows (mask,
    step, rank, removed, redundant, alone): by how much each figure of that
    step changes at that rank against the rank before.

    removed: the step's filter takes the document; redundant: the document
    fails the step's filter but has gone before; alone: it fails that filter
    and no other. Neighbouring intervals cancel where they meet."""
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {n}")
    out = []
    for mask in range(1, 1 << n):
        change: dict[tuple[int, int], list[int]] = {}
        for step in range(1, n + 1):
            for prefix in permutations(range(n), step):
                if not mask >> prefix[-1] & 1:
                    continue
                gone = any(mask >> x & 1 for x in prefix[:-1])
                figures = (not gone, gone, mask == 1 << prefix[-1])
                first = lehmer_rank(prefix, n)
                for at, sign in ((first, 1), (first + factorial(n - step), -1)):
                    here = change.setdefault((step, at), [0, 0, 0])
                    for k, holds in enumerate(figures):
                        here[k] += sign * holds
        out += [(mask, step, at, *v) for (step, at), v in sorted(change.items()) if any(v) and at < factorial(n)]
    return out


def _orders(letters: str) -> list[str]:
    """All orders of the filters by rank: the i-th permutation has Lehmer rank i."""
    return ["".join(p) for p in permutations(letters)]


def audit(counts: DataFrame, letters: str, tallies: tuple[str, ...] = ()) -> DataFrame:
    """One row per part, order and step from documents counted by mask.

    ``counts`` has columns part (string), mask (int; bit i set: the document
    fails the filter ``letters[i]``), n (documents) and one count per name of
    ``tallies`` (documents of the row that have a property); rows of one part
    and mask add up. ``letters`` must be distinct and in ascending order.

    Returns part, filter_order, step (from 1) and, of the filter at that step:
    kept (left after it), removed (taken by it), redundant (fail it, taken
    before), unique_fails (fail nothing else), ``<tally>_lost`` (taken by it,
    with that property) and shapley (removed, summed over all orders, at
    whatever step). Rows that hold zeros are there. No counts, no rows.
    """
    n = len(letters)
    if list(letters) != sorted(set(letters)):
        raise ValueError("filter letters must be distinct and ascending")
    spark = counts.sparkSession
    orders = _orders(letters)
    # at most 2^n rows a part, however many documents it has; written, as the
    # changes and the grid both read it
    counts = counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in tallies])
    counts = materialize(counts, "mask_counts")

    # size fixed by the number of filters: at most 2^n * n! rows
    table = spark.createDataFrame(rank_intervals(n), "mask int, step int, rank int, d_removed int, d_redundant int, d_alone int")
    met = counts.join(F.broadcast(table), "mask")
    sums = {
        "removed": F.col("d_removed") * F.col("n"),
        "redundant": F.col("d_redundant") * F.col("n"),
        "unique_fails": F.col("d_alone") * F.col("n"),
        **{f"{t}_lost": F.col("d_removed") * F.col(t) for t in tallies},
    }
    zero = F.lit(0).cast("bigint")
    changes = met.select("part", "rank", "step", zero.alias("total"), *[v.alias(k) for k, v in sums.items()])
    # every rank and step of a part, with the part's documents
    grid = counts.select("part", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"), F.col("n").alias("total"))
    grid = grid.select("part", "rank", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"), "total", *[zero.alias(k) for k in sums])
    # all later steps keep the partitioning by part: n! * n rows of each
    changes = changes.unionByName(grid).repartition("part").groupBy("part", "rank", "step").agg(
        *[F.sum(k).alias(k) for k in ("total", *sums)]
    )

    upto = Window.partitionBy("part", "step").orderBy("rank")
    found = changes.select("part", "rank", "step", "total", *[F.sum(k).over(upto).alias(k) for k in sums])
    order = F.element_at(F.array(*[F.lit(x) for x in orders]), F.col("rank") + 1)
    found = found.withColumn("filter_order", order)
    found = found.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    found = found.withColumns({
        "kept": F.col("total") - F.sum("removed").over(so_far),
        "shapley": F.sum("removed").over(Window.partitionBy("part", "letter")),
    })
    figures = ["kept", *sums, "shapley"]
    return found.select("part", "filter_order", "step", *[F.col(c).cast("bigint").alias(c) for c in figures])


def text_faults(text: Column) -> dict[str, Column]:
    """The conditions on a text alone, by filter letter; true: it fails."""
    words = F.array_remove(F.split(text, WORD_GAP), "")
    n = F.size(words).cast("bigint")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint")
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 65 * n,
        "C": 100 * capitals > 5 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def count_faults(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` counted by part and mask, for :func:`audit` with the
    letters ABCDE and the tallies good and toxic.

    A: under 50 words; B: under 65 % of the words distinct; C: over 5 % of
    the code points are A-Z; D: holds one of ``#$%&*|``; E: the text of a
    smaller doc_id, anywhere in the table. A null text is an empty one, a
    null source the part ''. Rows without doc_id have no smaller one: they
    neither fail E nor make others fail it; rows alike in doc_id and text
    fail it alike. good and toxic: a row of ``labels`` with that doc_id has
    quality 1, toxic 1 (of several rows any one is enough; none: neither).

    Texts are read once, into one narrow row a document. Nothing is dealt
    out by text or source alone: the first id of a text is a partial
    aggregate, and documents meet it by text and id together.
    """
    src = named(docs, doc_id="doc_id", text="text", part="source")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = src.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(text_faults(F.col("text")).values())), F.lit(0))
    rows = src.select("doc_id", "part", bits.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    rows = materialize(rows, "filter_faults")

    first = rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("digest", "doc_id", F.lit(True).alias("is_first"))
    marks = named(labels, doc_id="doc_id", quality="quality", toxic="toxic").where(F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    rows = rows.withColumn("mask", F.col("mask") + F.when(again, F.lit(1 << 4)).otherwise(F.lit(0)))
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(F.col(c).cast("bigint"), F.lit(0))).alias(c) for c in ("good", "toxic")],
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of :func:`count_faults` on ``docs``."""
    return audit(count_faults(docs, labels), "ABCDE", ("good", "toxic"))
