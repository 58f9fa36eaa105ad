"""Toxicity: a counterfactually regularised word classifier.

Logistic regression over the words a text holds and the beginnings that its
words share (present or not, so length is no evidence; inflected insults
meet in their stem), with an L1 penalty that leaves only features which
matter, and a counterfactual penalty: a labelled text and the same text with
its group mentions swapped for others of their kind must get the same score.
Labelled texts seldom mention a group, and where they do the mentions may go
with the label. So every text is also used with a neutral mention put in,
label unchanged, and the swaps are taken of that, too. Neutral mentions then
carry no weight of their own, nor do the stems that they share with insults.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import bounded_sample, map_texts, named, sample_keys

# Group mentions; the terms of one line are swapped for one another.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("juden", "muslime", "christen", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "filles", "garçons"),
    ("juifs", "musulmans", "chrétiens", "immigrés", "réfugiés"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("judíos", "musulmanes", "cristianos", "inmigrantes", "refugiados"),
)
_WORD = re.compile(r"\w+")


# Lengths of the word beginnings that count as features.
STEMS = (4, 6)
# A stem is a feature anew when so many different words of a text share it.
STEM_COUNTS = (1, 2, 4)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """Words, and ``stem*n`` where at least n different words start with stem."""
    stems = Counter(w[:k] for w in words for k in STEMS if len(w) >= k)
    return words | {f"{stem}*{n}" for stem, held in stems.items() for n in STEM_COUNTS if held >= n}


def counterfactuals(words: set[str], groups=IDENTITY_GROUPS) -> list[set[str]]:
    """The word set with all of its group mentions moved on to the next term
    of their group, once for every step; none without a mention."""
    held = [(g, [i for i, t in enumerate(g) if t in words]) for g in groups]
    held = [(g, at) for g, at in held if at]
    if not held:
        return []
    rest = words.difference(*(g for g, _ in held))
    out = []
    for step in range(1, max(len(g) for g, _ in held)):
        swapped = rest.union(*({g[(i + step) % len(g)] for i in at} for g, at in held))
        if swapped != words:
            out.append(swapped)
    return out


def put_in(words: set[str], number: int, groups=IDENTITY_GROUPS) -> tuple[set[str], list[set[str]]]:
    """(the words with one neutral mention put in, the same with each other
    term of its group in its place). ``number`` picks group and term in turn;
    terms that the text holds already are left to :func:`counterfactuals`."""
    group = groups[number % len(groups)]
    free = [t for t in group if t not in words]
    if len(free) < 2:
        return words, []
    term = free[number // len(groups) % len(free)]
    return words | {term}, [words | {t} for t in free if t != term]


@dataclass(frozen=True)
class ToxicityModel:
    """``swaps``: pairs of texts that the counterfactual penalty has compared;
    ``gap``: the root mean square of what is left of their difference, before
    the logistic function."""

    weights: dict[str, float]
    bias: float
    swaps: int = 0
    gap: float = 0.0

    def score(self, text: str | None) -> float:
        """Probability of label 1; an empty or null text gets the bias alone."""
        found = [self.weights[f] for f in features_of(words_of(text)) if f in self.weights]
        z = self.bias + math.fsum(found)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def train(
    texts: list[set[str]],
    toxic: np.ndarray,
    min_docs: int = 8,
    max_features: int = 3_000,
    l1: float = 3e-4,
    counterfactual: float = 1.0,
    steps: int = 200,
) -> ToxicityModel:
    """Accelerated proximal gradient on log loss + counterfactual penalty,
    soft-thresholded for the L1 part. Classes weigh the same in all, and a
    text as it is as much as with a mention put in. Features are those of at
    least ``min_docs`` training texts: the ``max_features`` that go most with
    the label, and besides them all that a swap changes, so that the penalty
    reaches them."""
    if not len(texts) or toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(texts) else 0.0
        return ToxicityModel({}, float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -7, 7)))

    plain, toxic = texts, np.concatenate([toxic, toxic])

    # made anew whenever they are gone through: only numbers are kept of them
    def rows_of_text():
        yield from plain
        for i, t in enumerate(plain):
            yield put_in(t, i)[0]

    def swaps_of_text():
        for i, t in enumerate(plain):
            mentioned, others = put_in(t, i)
            yield from ((mentioned, o) for o in others)
            yield from ((t, c) for c in counterfactuals(t))

    known, in_toxic = Counter(), Counter()
    for t, bad in zip(rows_of_text(), toxic):
        features = features_of(t)
        known.update(features)
        if bad:
            in_toxic.update(features)
    often = sorted(f for f, n in known.items() if n >= min_docs)

    def association(f: str) -> float:
        """How many standard errors its share of toxic texts is off."""
        n, share = known[f], toxic.mean()
        return abs(in_toxic[f] - n * share) / np.sqrt(n * share * (1 - share))

    mentions = features_of({x for g in IDENTITY_GROUPS for x in g})
    often = sorted(often, key=association, reverse=True)[:max_features] + [f for f in often if f in mentions]
    often = list(dict.fromkeys(often))
    vocabulary = {f: i for i, f in enumerate(sorted(often))}
    del known, in_toxic
    n = len(toxic)

    def columns(features):
        return np.array(sorted(map(vocabulary.__getitem__, features.intersection(vocabulary))), np.int32)

    def sparse(sets):
        """Row and column numbers of the ones of a 0/1 matrix, its rows."""
        held = [columns(x) for x in sets]
        sizes = [len(x) for x in held]
        return np.repeat(np.arange(len(held), dtype=np.int32), sizes), np.concatenate([*held, np.zeros(0, np.int32)])

    rows, cols = sparse(map(features_of, rows_of_text()))
    gone, come = [], []
    for before, after in swaps_of_text():  # of a swap only the features that differ
        a, b = _differing(before, after, vocabulary)
        gone.append(columns(a))
        come.append(columns(b))
    swaps = len(gone)
    each_way = [(np.repeat(np.arange(swaps), [len(x) for x in way]), np.concatenate([*way, np.zeros(0, np.int32)])) for way in (gone, come)]
    del gone, come
    d_rows, d_cols = (np.concatenate([way[k] for way in each_way]) for k in (0, 1))
    d_sign = np.repeat([1.0, -1.0], [len(way[0]) for way in each_way])

    y = toxic.astype(float)
    each = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    m = len(vocabulary)
    rate = 4.0
    w, v, b, vb, t = np.zeros(m), np.zeros(m), 0.0, 0.0, 1.0

    def objective_gradient(w, b):
        z = np.bincount(rows, w[cols], n) + b
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        loss = float(each @ np.logaddexp(0, np.where(toxic, -z, z)))
        e = each * (p - y)
        g = np.bincount(cols, e[rows], m)
        if swaps:
            d = np.bincount(d_rows, d_sign * w[d_cols], swaps)
            loss += counterfactual * float(d @ d) / swaps
            g += 2 * counterfactual / swaps * np.bincount(d_cols, d_sign * d[d_rows], m)
        return loss, g, float(e.sum())

    for _ in range(steps):
        loss, g, gb = objective_gradient(v, vb)
        while True:  # backtracking keeps the step inside the curvature
            step = v - rate * g
            new = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0.0)
            new_b = vb - rate * gb
            dw, db = new - v, new_b - vb
            bound = loss + g @ dw + gb * db + (dw @ dw + db * db) / (2 * rate)
            if objective_gradient(new, new_b)[0] <= bound + 1e-12 or rate < 1e-6:
                break
            rate *= 0.5
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), new_b + (t - 1) / nt * (new_b - b)
        w, b, t = new, new_b, nt
    left = np.bincount(d_rows, d_sign * w[d_cols], swaps) if swaps else np.zeros(1)
    weights = {x: float(w[i]) for x, i in vocabulary.items() if w[i] != 0.0}
    return ToxicityModel(weights, float(b), swaps, float(np.sqrt(np.mean(left * left))))


def _differing(before: set[str], after: set[str], vocabulary: dict[str, int]) -> tuple[set[str], set[str]]:
    """(features gone, features come) of a swap, of those in the vocabulary.
    Only stems of words that have gone or come can change their count."""
    gone, come = before - after, after - before
    stems = {w[:k] for w in gone | come for k in STEMS if len(w) >= k}
    near = gone | come | {w for w in before | after if any(w[:k] in stems for k in STEMS)}
    a, b = (features_of(near & x).intersection(vocabulary) for x in (before, after))
    return a - b, b - a


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training: Column | None = None,
    sample_rows: int = 6_000,
) -> ToxicityModel:
    """Learn from at most ``sample_rows`` labelled rows (smallest id hash,
    at most ``common.SAMPLE_BYTES`` of text) for which ``training`` (a
    condition on ``doc_id``) holds; see :func:`train` for its parameters."""
    wanted = named(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
    wanted = wanted.where(F.lit(True) if training is None else training).distinct()
    chosen = F.broadcast(bounded_sample(wanted, "doc_id", sample_rows))
    rows = named(docs, doc_id=id_col, text=text_col).join(chosen, "doc_id")
    rows = rows.select("doc_id", "toxic", F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample_keys(rows, "doc_id", "text", sample_rows)), "doc_id", "left_semi")
    rows = rows.orderBy("doc_id", "toxic", "text")
    texts, toxic, shared = [], [], {}
    for r in rows.limit(sample_rows).toLocalIterator():  # only the word sets are kept
        texts.append({shared.setdefault(w, w) for w in words_of(r["text"])})
        toxic.append(r["toxic"] == 1)
    return train(texts, np.array(toxic, bool))


def classify(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, one row per input row, no shuffle; whole texts.
    Null texts score as empty ones; other columns are ignored."""

    def make():
        return lambda texts: [[model.score(t) for t in texts]]

    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return map_texts(src, ["doc_id"], "text", "score double", make)
