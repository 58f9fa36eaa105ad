"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then temperature calibration.

Document frequencies are counted over every training document (one pass,
pre-aggregated per task, at most DIMS rows meet); the weights are learned on
a bounded, hash-chosen sample of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import begin, filter_texts, map_texts, named, sample_keys

DIMS = 1 << 15
UNDETERMINED = "und"
# Odd 32-bit multipliers, one per place in an n-gram.
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1-, 2- and 3-grams of the lower-cased whole text: (bucket, count)."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    grams, h = [], np.zeros(len(cp), np.uint32)
    for n, mix in enumerate(_MIX, 1):
        if len(cp) < n:
            break
        h = h[: len(cp) - n + 1] * np.uint32(31) + cp[n - 1 :] * mix + np.uint32(n)
        grams.append((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17))
    counts = np.bincount(np.concatenate(grams), minlength=DIMS)
    hit = np.flatnonzero(counts)
    return hit, counts[hit]


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L2-normalised (bucket, value) of a non-empty text."""
    at, counts = _gram_counts(text)
    v = np.log1p(counts) * idf[at]
    return at, v / max(float(np.sqrt(v @ v)), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # [DIMS, languages], mostly zero
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); ``und`` and 0.0 where the text
        is null or holds no letter, or nothing was learned."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        at, v = tf_idf(text, self.idf)
        p = _softmax((v @ self.weights[at] + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(documents holding each bucket, documents with a letter), over all of
    ``docs``. Every task adds up its own documents first."""
    src = named(docs, text=text_col).withColumn("text", F.col("text").cast("string"))

    def count(batches):
        begin()
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if has_letter(text):
                    df[_gram_counts(text)[0]] += 1
                    n += 1
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, -1), pa.int32()), pa.array(np.append(df[hit], n), pa.int64())], ["bucket", "n"]
        )

    rows = src.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(DIMS, np.int64), 0
    for r in rows:  # at most DIMS + 1
        if r["bucket"] < 0:
            total = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, total


def train_ftrl(
    examples: list[tuple[np.ndarray, np.ndarray]],
    target: np.ndarray,
    classes: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.5,
    l2: float = 0.1,
    epochs: int = 3,
    seed: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; (weights, bias)."""
    z, n = np.zeros((DIMS + 1, classes)), np.zeros((DIMS + 1, classes))

    def weights(at, first=l1):
        zz = z[at]
        w = -(zz - np.sign(zz) * first) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zz) <= first, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, v = examples[i]
            at, v = np.append(at, DIMS), np.append(v, 1.0)  # the last coordinate is the bias
            w = weights(at)
            p = _softmax(v @ w)
            p[target[i]] -= 1.0
            g = v[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    full = weights(np.arange(DIMS + 1))
    return full[:-1], full[-1]


def calibrate_temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(target)), target]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    training: Column | None = None,
    sample_rows: int = 6_000,
    calibration_share: float = 0.2,
) -> LanguageModel:
    """Learn from the rows of ``docs`` with a non-null language for which
    ``training`` (a condition on column ``doc_id``) holds. The weights and
    the temperature see at most ``sample_rows`` of them (and at most
    ``common.SAMPLE_BYTES`` of text), disjoint parts."""
    src = named(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("text", F.col("text").cast("string"))
    src = src.where(F.col("lang").isNotNull() & (F.lit(True) if training is None else training))
    df, total = document_frequencies(src)
    idf = np.log((1 + total) / (1 + df)) + 1.0
    ids = sample_keys(src, "doc_id", "text", sample_rows)
    rows = src.join(F.broadcast(ids), "doc_id", "left_semi").orderBy("doc_id", "lang", "text").limit(sample_rows)
    vectors, names = [], []
    for r in rows.toLocalIterator():  # a few texts at a time; only their n-grams are kept
        if has_letter(r["text"]):
            vectors.append(tf_idf(r["text"], idf))
            names.append(str(r["lang"]))
    languages = tuple(sorted(set(names)))
    if not languages:
        return LanguageModel((), idf, np.zeros((DIMS, 0)), np.zeros(0), 1.0)
    target = np.array([languages.index(x) for x in names])
    order = np.random.default_rng(5).permutation(len(target))
    held = order[: int(len(order) * calibration_share)]
    used = order[len(held) :]
    w, bias = train_ftrl([vectors[i] for i in used], target[used], len(languages))
    logits = np.array([vectors[i][1] @ w[vectors[i][0]] + bias for i in held]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, w, bias, calibrate_temperature(logits, target[held]))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score; one row per input row, no shuffle. Null or
    letterless texts get ``und`` and 0.0; other columns are ignored."""

    def make():
        return lambda texts: list(zip(*map(model.predict, texts))) or [[], []]

    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return map_texts(src, ["doc_id"], "text", "lang_pred string, score double", make)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with a
    probability of at least ``min_score``. A model that learned nothing (no
    row had a language) rejects nothing but texts without a letter."""

    def make():
        def f(texts):
            if not model.languages:
                return [has_letter(t) for t in texts]
            found = map(model.predict, texts)
            return [lang != UNDETERMINED and score >= min_score for lang, score in found]

        return f

    return filter_texts(docs, text_col, make)
