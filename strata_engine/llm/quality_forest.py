"""Quality rules: exact rule statistics per document and an isolation forest
over them.

Statistics are counted on whole texts, one pass, no shuffle. The bounds of
ordinary ratios, the rows in every leaf of the forest and the cut come from
all labelled rows, by aggregates over a table of their ratios. Only where a
tree splits is drawn at random, as an isolation forest does: between the
extremes of ``tree_rows`` rows drawn for that tree. A document whose mean
isolation depth is unusually short is anomalous. The cut on that depth is the
one that finds the most rows labelled bad while rejecting at most
``max_clean_loss`` of the good ones. The base rules (too few words, too many
repeated words) need no model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import filter_texts, map_texts, named, text_bytes
from strata_engine.session import materialize

COUNT_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STAT_COLUMNS = (*COUNT_COLUMNS, "n_lines", "n_upper", "n_distinct_words")
STAT_SCHEMA = ", ".join(f"{c} bigint" for c in STAT_COLUMNS)

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def _removed(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def _repeat_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    m = len(number)
    if m < 2_000_000:  # three ids fit in one 64-bit number
        key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        pair = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1]
        key = pair[:-1] * m + ids[2:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    hit = counts[inverse] >= 2
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= hit
    return int(covered.sum())


def count_stats(data: bytes | None) -> tuple[int, ...]:
    """STAT_COLUMNS of one UTF-8 text (None: as the empty text)."""
    data = data or b""
    words = data.split()  # bytes.split() splits at exactly 0x20 and 0x09-0x0D
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(data) - _removed(data, _SPACES) - _removed(data, _CONTINUATION),
        _removed(data, _SYMBOLS),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        _removed(data, _UPPER),
        len(set(words)),
    )


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and STAT_COLUMNS. Null text counts
    as empty (all zero); null ids, repeated rows and empty tables pass
    through; other columns of ``docs`` are ignored."""

    def make():
        return lambda texts: list(zip(*map(count_stats, texts)))

    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", text_bytes("text"))
    return map_texts(src, ["doc_id"], "text", STAT_SCHEMA, make)


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Rule ratios, one row per document; every ratio is defined for empty texts."""
    n = np.maximum(stats["n_words"], 1).astype(float)
    lines = np.maximum(stats["n_lines"], 1).astype(float)
    chars = np.maximum(stats["word_chars"], 1).astype(float)
    return np.column_stack([
        np.clip(stats["word_chars"] / n, 0, 20),
        np.minimum(stats["n_symbols"] / n, 1.0),
        stats["n_dup_lines"] / lines,
        stats["n_repeat_words"] / n,
        stats["n_upper"] / chars,
        # repeated vocabulary beyond what a text of that length has anyway
        np.log1p(n / np.maximum(stats["n_distinct_words"], 1)) / np.log1p(np.log1p(n) + 1.0),
    ])


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n points."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2.0)
    out = 2.0 * (np.log(np.maximum(safe - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, out, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Random-split trees as arrays [tree, node]; children of i are 2i+1, 2i+2."""

    feature: np.ndarray  # -1: leaf
    split: np.ndarray
    path: np.ndarray  # path length credited at a leaf
    depth: int
    sample: int

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Per tree the leaf of every row."""
        rows = np.arange(len(x))
        for feature, split in zip(self.feature, self.split):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            yield node

    def counts(self, x: np.ndarray) -> np.ndarray:
        """Rows per [tree, node] (0 but at leaves)."""
        return np.array([np.bincount(leaf, minlength=self.path.shape[1]) for leaf in self.leaves(x)])

    def credited(self, counts: np.ndarray) -> Forest:
        """The same trees, their leaves credited for the share of all rows
        that ``counts`` finds there, on the scale of ``sample`` rows."""
        share = np.rint(counts * (self.sample / np.maximum(counts.sum(1, keepdims=True), 1)))
        level = np.floor(np.log2(np.arange(1, self.path.shape[1] + 1)))
        return replace(self, path=np.where(self.feature < 0, level + _average_path(share), 0.0))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1); higher is more anomalous."""
        if not len(x):
            return np.zeros(0)
        total = np.zeros(len(x))
        for path, leaf in zip(self.path, self.leaves(x)):
            total += path[leaf]
        return 2.0 ** (-(total / len(self.feature)) / max(float(_average_path(self.sample)), 1e-9))


def fit_forest(x: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    """Isolation forest: each tree isolates ``sample`` rows by splits on a
    random feature at a random value between its extremes."""
    rng = np.random.default_rng(seed)
    sample = int(min(sample, len(x)))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int64)
    split = np.zeros((trees, nodes))
    path = np.zeros((trees, nodes))
    for t in range(trees):
        stack = [(0, x[rng.choice(len(x), sample, replace=False)], 0)]
        while stack:
            node, part, level = stack.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(x.shape[1]),) * 2
            wide = np.flatnonzero(high > low)
            if level == depth or len(part) < 2 or not len(wide):
                path[t, node] = level + float(_average_path(len(part)))
                continue
            f = int(rng.choice(wide))
            at = float(rng.uniform(low[f], high[f]))
            at = at if at > low[f] else float(high[f])
            feature[t, node], split[t, node] = f, at
            right = part[:, f] >= at
            stack += [(2 * node + 1, part[~right], level + 1), (2 * node + 2, part[right], level + 1)]
    return Forest(feature, split, path, depth, sample)


def calibrate(scores: np.ndarray, good: np.ndarray, max_clean_loss: float) -> float:
    """Smallest score to reject: the cut with the best recall of bad rows
    whose loss of good rows is at most ``max_clean_loss``; ties take the
    higher cut. Without bad rows only that loss bounds it."""
    clean, bad = np.sort(scores[good]), scores[~good]
    if not len(clean):
        return 1.0
    floor = clean[max(0, int(np.ceil(len(clean) * (1 - max_clean_loss))) - 1)]
    above = bad[bad > floor]
    if not len(above):
        return float(np.nextafter(clean[-1], 2))
    # halfway between the first bad score above the floor and the good one below it
    first = above.min()
    return float((clean[clean < first].max(initial=floor) + first) / 2)


@dataclass(frozen=True)
class QualityModel:
    """``low`` and ``high`` bound each ratio among good rows; the forest sees
    by how much a ratio lies outside them, so that ordinary variation inside
    the bounds is one point that no split can isolate. ``forest`` is None
    where no row could be learned from; then only the base rules judge."""

    low: np.ndarray
    high: np.ndarray
    forest: Forest | None
    cut: float

    def excess(self, ratios: np.ndarray) -> np.ndarray:
        return np.log1p(20 * (np.maximum(ratios - self.high, 0) + np.maximum(self.low - ratios, 0)))

    def score(self, stats: dict[str, np.ndarray]) -> np.ndarray:
        if self.forest is None:
            return np.zeros(len(stats["n_words"]))
        return self.forest.score(self.excess(features(stats)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 8_000,
    max_clean_loss: float = 0.002,
    natural: float = 0.999,
    trees: int = 100,
    tree_rows: int = 64,
    min_words: int = 50,
    seed: int = 7,
) -> QualityModel:
    """Fit on all labelled documents. Rows the base rules fail already (fewer
    than ``min_words`` words, or half their words in repeated windows) take no
    part. A ratio is ordinary between the ``1 - natural`` and ``natural``
    quantiles of the good rows. ``sample_rows`` bounds only the rows among
    which the trees' own draws of ``tree_rows`` are made."""
    rows = _labelled_ratios(docs, labels, id_col, text_col, label_col, min_words)
    good = rows.where("good")
    n_good = good.count()
    if not n_good:
        return QualityModel(np.zeros(0), np.zeros(0), None, 1.0)
    low, high = exact_quantiles(good, RATIOS, [1 - natural, natural], n_good)
    model = QualityModel(low, high, None, 1.0)
    drawn = rows.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "good", *RATIOS).limit(sample_rows)
    drawn = sorted(tuple(r) for r in drawn.select("doc_id", "good", *RATIOS).collect())  # at most sample_rows
    forest = fit_forest(model.excess(np.array([r[2:] for r in drawn])), trees, tree_rows, seed)
    model = replace(model, forest=forest.credited(_leaf_counts(rows, model, forest)))
    scored = materialize(_scored(rows, model), "quality_scores")
    return replace(model, cut=_calibrated(scored, n_good, max_clean_loss))


RATIOS = [f"r{i}" for i in range(6)]


def _labelled_ratios(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, min_words: int
) -> DataFrame:
    """doc_id, good and RATIOS of every labelled document that the base rules pass, written once."""

    def make():
        def run(texts):
            stats = _stats(texts)
            return [base_failed(stats, min_words), *features(stats).T]

        return run

    marks = named(labels, doc_id=id_col, good=label_col).where("doc_id is not null and good is not null").distinct()
    src = named(docs, doc_id=id_col, text=text_col).where("doc_id is not null").withColumn("text", text_bytes("text"))
    ratios = map_texts(src, ["doc_id"], "text", "failed boolean, " + ", ".join(f"{c} double" for c in RATIOS), make)
    rows = ratios.where("not failed").join(marks, "doc_id").select("doc_id", (F.col("good") == 1).alias("good"), *RATIOS)
    return materialize(rows, "quality_ratios")


# Intervals into which a round of order_statistics cuts each of its ranges.
BINS = 1024


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The exact values at 0-based ``ranks`` of double columns (finite, no
    nulls, more rows than any rank). A round counts the rows per interval of
    the range that holds a rank and goes on in that interval, until it holds
    one value; at most BINS + 1 rows per rank come to the driver."""
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ranks for f in (F.min, F.max)]).first()
    todo = [(c, k, k, ends[f"min_{c}"], ends[f"max_{c}"]) for c, wanted in ranks.items() for k in set(wanted)]
    found = {}
    while todo:
        found |= {(c, k): low for c, k, _, low, high in todo if low == high}
        todo = [x for x in todo if x[3] < x[4]]
        spans = sorted({(c, low, high) for c, _, _, low, high in todo})
        if not spans:
            break
        # both ends of a range lie in different intervals, so every round narrows it
        items = [
            F.when(
                F.col(c).between(low, high),
                F.struct(F.lit(i).alias("span"), F.floor((F.col(c) - low) / (high - low) * BINS).alias("bin"), F.col(c).alias("value")),
            )
            for i, (c, low, high) in enumerate(spans)
        ]
        counts = df.select(F.explode(F.array(*items)).alias("x")).where("x is not null").groupBy("x.span", "x.bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("x.value").alias("low"), F.max("x.value").alias("high")
        )
        held: dict = {}
        for r in counts.orderBy("span", "bin").collect():
            held.setdefault(spans[r["span"]], []).append(r)
        narrowed = []
        for c, k, at, low, high in todo:
            for r in held[c, low, high]:
                if at < r["n"]:
                    narrowed.append((c, k, at, r["low"], r["high"]))
                    break
                at -= r["n"]
        todo = narrowed
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], n: int) -> np.ndarray:
    """[share, column]: quantiles of all ``n`` rows, between two rows by
    straight line (as ``np.quantile``)."""
    at = [(n - 1) * q for q in shares]
    pairs = [(math.floor(p), min(math.floor(p) + 1, n - 1)) for p in at]
    value = order_statistics(df, {c: [k for pair in pairs for k in pair] for c in columns})

    def between(c, p, j, k):
        return float(np.quantile([value[c, j], value[c, k]], p - j))

    return np.array([[between(c, p, j, k) for c in columns] for p, (j, k) in zip(at, pairs)])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in RATIOS])


def _leaf_counts(rows: DataFrame, model: QualityModel, forest: Forest) -> np.ndarray:
    """All rows per [tree, node]; a task sends one row per leaf that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(forest.path.shape, np.int64)
        for batch in batches:
            total += forest.counts(model.excess(_matrix(batch)))
        tree, node = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, pa.int32()), pa.array(node, pa.int32()), pa.array(total[tree, node], pa.int64())], ["tree", "node", "n"]
        )

    out = np.zeros(forest.path.shape, np.int64)
    sums = rows.select(*RATIOS).mapInArrow(run, "tree int, node int, n bigint").groupBy("tree", "node").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most the leaves of the forest
        out[r["tree"], r["node"]] = r["n"]
    return out


def _scored(rows: DataFrame, model: QualityModel) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.forest.score(model.excess(_matrix(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(score, pa.float64())], ["good", "score"])

    return rows.select("good", *RATIOS).mapInArrow(run, "good boolean, score double")


def _calibrated(scored: DataFrame, n_good: int, max_clean_loss: float) -> float:
    """:func:`calibrate` over a table of good and score with ``n_good`` > 0 good rows."""
    good, bad = scored.where("good"), scored.where("not good")
    rank = max(0, int(np.ceil(n_good * (1 - max_clean_loss))) - 1)
    floor = order_statistics(good, {"score": [rank]})["score", rank]
    first = bad.where(F.col("score") > floor).agg(F.min("score")).first()[0]
    if first is None:
        return float(np.nextafter(good.agg(F.max("score")).first()[0], 2))
    below = good.where(F.col("score") < first).agg(F.max("score")).first()[0]
    return float((max(below if below is not None else floor, floor) + first) / 2)


def base_failed(stats: dict[str, np.ndarray], min_words: int = 50) -> np.ndarray:
    n = stats["n_words"]
    return (n < min_words) | (100 * stats["n_repeat_words"] > 50 * n)


def _stats(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    columns = [np.array(c, np.int64) for c in zip(*map(count_stats, texts))] or [np.zeros(0, np.int64)] * len(STAT_COLUMNS)
    return dict(zip(STAT_COLUMNS, columns))


def _judged(texts: list[bytes | None], model: QualityModel, min_words: int) -> list[np.ndarray]:
    """STAT_COLUMNS, base_failed, anomaly, kept of some texts."""
    stats = _stats(texts)
    failed, score = base_failed(stats, min_words), model.score(stats)
    return [*stats.values(), failed, score, ~failed & (score < model.cut)]


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", min_words: int = 50) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    return filter_texts(docs, text_col, lambda: lambda texts: _judged(texts, model, min_words)[-1], binary=True)


def judge(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50
) -> DataFrame:
    """doc_id, STAT_COLUMNS, base_failed, anomaly (score of the forest) and
    kept, one row per input row, no shuffle. Empty or null texts fail the
    base rules; null ids, repeated rows and empty tables pass through; other
    columns are ignored."""

    def make():
        return lambda texts: _judged(texts, model, min_words)

    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", text_bytes("text"))
    return map_texts(
        src, ["doc_id"], "text", f"{STAT_SCHEMA}, base_failed boolean, anomaly double, kept boolean", make
    )
