"""Classifiers: base statistics against brute force, held-out accuracy, and
defined results for awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata_engine.llm import langid, quality_forest, toxicity
from strata_engine.llm.common import fold

from .conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] >= 2 for j in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_counts_match_brute_force(documents, awkward):
    got = quality_forest.rule_stats(documents(awkward)).collect()
    assert len(got) == len(awkward)
    expected = Counter((i, *brute_stats(t)) for i, t in awkward)
    assert Counter((r.doc_id, *(r[c] for c in quality_forest.COUNT_COLUMNS)) for r in got) == expected


def test_repeat_words_beyond_packed_numbers(monkeypatch):
    # the two-step numbering gives what the packed one does
    rng = random.Random(1)
    data = [rng.randrange(6) for _ in range(200)]
    byte_words = [str(x).encode() for x in data]
    assert quality_forest._repeat_words(byte_words) == brute_stats(" ".join(map(str, data)))[4]


def make_quality(documents, n=400):
    rng = random.Random(2)
    pairs, good = [], []
    for i in range(n):
        kind = i % 8
        t = ". ".join(words(rng, 12).capitalize() for _ in range(8))
        if kind == 0:
            t = " ".join(w + "$$$" for w in t.split())
        elif kind == 1:
            t = t.upper()
        pairs.append((i, t))
        good.append(int(kind > 1))
    return pairs, good


def test_forest_rejects_marked_rows_and_keeps_clean_ones(documents):
    pairs, good = make_quality(documents)
    df = documents(pairs, quality=good)
    model = quality_forest.fit(df, df, sample_rows=200)
    got = {r.doc_id: r for r in quality_forest.judge(df, model).collect()}
    unseen = [i for i, _ in pairs]
    assert np.mean([got[i].kept == bool(good[i]) for i in unseen]) > 0.97
    kept = {r.doc_id for r in quality_forest.keep_good(df, model).collect()}
    assert kept == {i for i, r in got.items() if r.kept}
    assert quality_forest.keep_good(df, model).columns == df.columns


def test_quality_defined_results(documents, awkward, spark):
    df = documents(awkward)
    none = documents([], quality=[])
    model = quality_forest.fit(df, none)  # nothing to learn from: base rules only
    rows = quality_forest.judge(df, model).collect()
    assert len(rows) == len(awkward)
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3, 4))
    assert quality_forest.judge(none, model).count() == 0
    labels = documents([(None, None), (7, None), (7, None)], quality=[1, None, 1])
    quality_forest.judge(df, quality_forest.fit(df, labels)).collect()


def test_isolation_scores_and_calibration():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (500, 3)), [[12, 12, 12]]])
    forest = quality_forest.fit_forest(x, 50, 128, 1)
    score = forest.score(x)
    assert score.argmax() == 500 and forest.score(x[:0]).shape == (0,)
    good = np.arange(501) < 500
    assert score[500] >= quality_forest.calibrate(score, good, 0.01)
    assert (score[good] >= quality_forest.calibrate(score, good, 0.0)).sum() == 0
    assert quality_forest.calibrate(score, np.zeros(501, bool), 0.1) == 1.0


def test_quality_is_learned_from_every_labelled_row(documents):
    pairs, good = make_quality(documents)
    df = documents(pairs, quality=good)
    few, many = (quality_forest.fit(df, df, sample_rows=n) for n in (70, 8_000))
    stats = quality_forest._stats([t.encode() for _, t in pairs])
    use = ~quality_forest.base_failed(stats)
    ratios, good = quality_forest.features(stats)[use], np.array(good, bool)[use]
    low, high = np.quantile(ratios[good], [1 - 0.999, 0.999], axis=0)
    for model in (few, many):  # however few rows the trees are drawn from
        np.testing.assert_allclose(model.low, low, rtol=1e-12)
        np.testing.assert_allclose(model.high, high, rtol=1e-12)
        x = model.excess(ratios)
        again = model.forest.credited(model.forest.counts(x))
        np.testing.assert_array_equal(again.path, model.forest.path)
        assert model.cut == quality_forest.calibrate(model.forest.score(x), good, 0.002)


def test_order_statistics_are_exact(spark):
    rng = np.random.default_rng(4)
    a = np.concatenate([np.zeros(500), rng.pareto(0.3, 900), [1e-12, 1e300]])
    b = rng.integers(0, 3, len(a)) / 7
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(5)
    ranks = [0, 1, 499, 500, 501, 700, len(a) - 2, len(a) - 1]
    found = quality_forest.order_statistics(df, {"a": ranks, "b": ranks})
    assert found == {(c, k): float(np.sort(v)[k]) for c, v in (("a", a), ("b", b)) for k in ranks}
    one = spark.createDataFrame([(2.5,)], "a double")
    assert quality_forest.exact_quantiles(one, ["a"], [0.001, 0.999], 1).tolist() == [[2.5], [2.5]]


def make_languages(n=240):
    rng = random.Random(3)
    sounds = {"aa": "tha ing ent ion er", "bb": "sch ung ein keit ü", "cc": "ção ão lh nh ê", "dd": "ija ova ski czy ł"}
    pairs, lang = [], []
    for i in range(n):
        name = rng.choice(list(sounds))
        parts = sounds[name].split()
        pairs.append((i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(30))))
        lang.append(name)
    return pairs, lang


def test_language_held_out_accuracy_and_calibration(documents):
    pairs, lang = make_languages()
    df = documents(pairs, lang=lang)
    model = langid.fit(df, training=fold("doc_id", 4) != 2)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    held = [i for i, _ in pairs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30
    assert np.mean([got[i].lang_pred == lang[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert (model.weights == 0).mean() > 0.5  # sparse


def test_language_defined_results(documents, awkward):
    pairs, lang = make_languages(80)
    model = langid.fit(documents(pairs + [(900, None), (901, "abc")], lang=lang + ["aa", None]))
    rows = langid.identify(documents(awkward), model).collect()
    assert len(rows) == len(awkward)
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3, 13, 16):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[12].lang_pred in model.languages
    untaught = langid.fit(documents([], lang=[]))
    assert untaught.languages == () and {r.lang_pred for r in langid.identify(documents(awkward), untaught).collect()} == {"und"}
    kept = langid.keep_identified(documents(awkward), model)
    assert not {1, 2, 3, 13, 16} & {r.doc_id for r in kept.collect()}


def test_document_frequencies_cover_all_rows(documents):
    df, total = langid.document_frequencies(documents([(i, "ab") for i in range(50)] + [(99, "cd"), (98, "12"), (97, None)]).repartition(7))
    assert total == 51 and df.max() == 50


def test_temperature_softens_overconfident_scores():
    rng = np.random.default_rng(1)
    target = rng.integers(0, 3, 600)
    logits = np.eye(3)[np.where(rng.random(600) < 0.7, target, rng.integers(0, 3, 600))] * 20
    assert langid.calibrate_temperature(logits, target) > 3
    assert langid.calibrate_temperature(logits[:0], target[:0]) == 1.0


def make_toxic(n=500):
    rng = random.Random(4)
    pairs, toxic = [], []
    groups = ["women", "muslims", "immigrants", "black", "gay"]
    for i in range(n):
        bad = i % 5 == 0
        t = words(rng, 40).split()
        if bad:
            t.insert(rng.randrange(40), rng.choice(["idiot", "scummy", "scumful"]))
        # mentions go with the label in these rows: women are insulted more often
        if rng.random() < (0.7 if bad else 0.1):
            t.insert(rng.randrange(40), "women")
        elif rng.random() < 0.3:
            t.insert(rng.randrange(40), rng.choice(groups[1:]))
        pairs.append((i, " ".join(t)))
        toxic.append(int(bad))
    return pairs, toxic


def test_toxicity_held_out_and_mentions_are_neutral(documents):
    pairs, toxic = make_toxic()
    df = documents(pairs, toxic=toxic)
    model = toxicity.fit(df, df, training=fold("doc_id", 5) != 0)
    got = {r.doc_id: r.score for r in toxicity.classify(df, model).collect()}
    held = [i for i, _ in pairs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == bool(toxic[i]) for i in held]) > 0.97
    w = [toxicity.words_of(t) for _, t in pairs]
    free = toxicity.train(w, np.array(toxic) == 1, counterfactual=0.0)
    assert abs(model.score("the women went home") - model.score("the men went home")) <= abs(
        free.score("the women went home") - free.score("the men went home")
    )
    strong = toxicity.train(w, np.array(toxic) == 1, counterfactual=20.0)
    assert abs(strong.score("the women went home") - strong.score("the men went home")) < 0.05
    assert model.score("the women went home") < 0.5


def test_counterfactuals_swap_within_groups():
    swapped = toxicity.counterfactuals({"the", "muslim", "doctor"})
    assert {"the", "christian", "doctor"} in swapped and all("doctor" in s and "muslim" not in s for s in swapped)
    assert toxicity.counterfactuals({"the", "doctor"}) == []


def test_mentions_put_in_are_swapped():
    base, others = toxicity.put_in({"the", "doctor"}, 3)
    term = (base - {"the", "doctor"}).pop()
    group = next(g for g in toxicity.IDENTITY_GROUPS if term in g)
    assert {frozenset(o) for o in others} == {frozenset({"the", "doctor", t}) for t in group if t != term}
    for k in range(200):
        a, swapped = toxicity.put_in({"muslim", "home"}, k)
        for b in swapped:
            whole = toxicity.features_of(a) - toxicity.features_of(b), toxicity.features_of(b) - toxicity.features_of(a)
            assert toxicity._differing(a, b, {f: 0 for x in whole for f in x}) == whole


def test_counterfactual_penalty_acts_on_the_given_documents(spark):
    """No labelled text of the given tables mentions a group; the penalty has
    swaps all the same, and narrows the scores of neutral sentences that
    differ in the mention alone."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").where(fold("doc_id", 5) != 0).select("text", "toxic").collect()
    texts, toxic = [toxicity.words_of(r.text) for r in rows], np.array([r.toxic == 1 for r in rows])
    model, free = (toxicity.train(texts, toxic, counterfactual=c) for c in (1.0, 0.0))
    assert model.swaps > len(texts) and model.swaps == free.swaps and model.gap < free.gap

    def spread(m):
        clean = [" ".join(sorted(t)) for t, bad in zip(texts, toxic) if not bad][:40]
        gaps = []
        for group in toxicity.IDENTITY_GROUPS:
            for t in clean:
                z = [m.bias + sum(m.weights.get(f, 0.0) for f in toxicity.features_of(toxicity.words_of(f"{t} {x}"))) for x in group]
                gaps.append(max(z) - min(z))
        return float(np.mean(gaps))

    assert spread(model) < 0.5 * spread(free)
    held = docs.join(labels, "doc_id").where(fold("doc_id", 5) == 0).select("text", "toxic").collect()
    right = [(model.score(r.text) >= 0.5) == (r.toxic == 1) for r in held if r.toxic is not None]
    assert np.mean(right) > 0.9


def test_toxicity_defined_results(documents, awkward):
    pairs, toxic = make_toxic(100)
    df = documents(pairs, toxic=toxic)
    model = toxicity.fit(df, documents([(None, "x"), (3, "y"), (3, "y")], toxic=[1, None, 0]))
    assert 0 <= model.score(None) < 0.5  # no row is toxic
    model = toxicity.fit(df, df)
    rows = toxicity.classify(documents(awkward), model).collect()
    assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {model.score("")}
    assert toxicity.classify(documents([]), toxicity.fit(documents([]), documents([], toxic=[]))).count() == 0


@pytest.mark.parametrize("modulus", [4, 5])
def test_fold_is_crc32_of_decimal_text(spark, modulus):
    rows = spark.range(200).select("id", fold("id", modulus).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % modulus for r in rows)
    assert spark.range(1).select(F.lit(None).cast("bigint").alias("id")).select(fold("id", modulus)).first()[0] is None
