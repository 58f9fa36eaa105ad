"""Similarity join and substring deduplication against brute force."""

from __future__ import annotations

import random
import re

import pytest

from strata_engine.llm import group_join, packed, seed_extend
from strata_engine.llm.components import connected

from .conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(pairs, percent=80):
    sets = {}
    for i, t in pairs:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]
            ):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed, n=160):
    """Unrelated texts, copies, near copies of several strengths, chains of
    near copies, and a passage that many unrelated texts share."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = words(rng, 150)
    out = []
    chain = words(rng, 120)
    for i in range(n):
        kind = i % 6
        if kind == 0:
            t = words(rng, rng.randint(1, 200), 3000)
        elif kind == 1:
            t = base
        elif kind == 2:
            t = edited(rng, base, rng.randint(0, 8))
        elif kind == 3:
            t = words(rng, 60, 3000) + " " + passage + " " + words(rng, 40, 3000)
        elif kind == 4:
            chain = edited(rng, chain, 1)
            t = chain
        else:
            t = base.upper() if i % 4 else edited(rng, base, 30)
        out.append((rng.randrange(10**9), t))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_brute_force(documents, seed):
    pairs = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in group_join.similar_components(documents(pairs)).collect()}
    expected = brute_components(pairs)
    assert got == {i: (len(shingles(t)), expected[i]) for i, t in pairs}


@pytest.mark.parametrize("percent, k", [(50, 3), (95, 5)])
def test_components_at_other_settings(documents, percent, k):
    rng = random.Random(9)
    base = words(rng, 60)
    pairs = [(i, edited(rng, base, i % 12)) for i in range(60)]
    got = {r.doc_id: r.component_id for r in group_join.similar_components(documents(pairs), words=k, percent=percent).collect()}
    sets = {i: shingles(t, k) for i, t in pairs}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_first_links_match_brute_force():
    import numpy as np

    rng = random.Random(3)
    base = rng.sample(range(10**9), 60)
    make = lambda: np.array(sorted(set(rng.sample(base, rng.randint(40, 60)) + rng.sample(range(10**9), rng.randint(0, 9)))))
    left, right = [make() for _ in range(30)], [make() for _ in range(40)]
    sets = lambda tokens, low: (np.arange(low, low + len(tokens)), np.array([len(t) for t in tokens]), tokens)
    a, b = group_join._first_links(sets(left, 0), sets(right, 100), 80)
    similar = lambda x, y: 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))
    assert dict(zip(a, b)) == {
        i: min(100 + j for j, y in enumerate(right) if similar(x, y)) for i, x in enumerate(left) if any(similar(x, y) for y in right)
    }


def test_small_buckets_and_blocks_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(group_join, "BUCKET_TOKENS", 40)
    monkeypatch.setattr(group_join, "ASKING_BLOCK", 3)
    monkeypatch.setattr(group_join, "MEMBER_BLOCK", 4)
    pairs = corpus(4, 80)
    got = {r.doc_id: r.component_id for r in group_join.similar_components(documents(pairs).repartition(5)).collect()}
    assert got == brute_components(pairs)


def test_join_past_the_broadcast_bound(spark, documents):
    spark.conf.set("strata.broadcast.maxRows", "1")
    try:
        pairs = corpus(5, 60)
        got = {r.doc_id: r.component_id for r in group_join.similar_components(documents(pairs)).collect()}
        assert got == brute_components(pairs)
        kept = {r.doc_id: (r.n_removed, r.kept) for r in seed_extend.deduplicate(documents(pairs)).collect()}
        assert kept == {i: v[1:] for i, v in brute_removed(pairs).items()}
    finally:
        spark.conf.unset("strata.broadcast.maxRows")


def test_join_defined_results(documents, awkward):
    rows = group_join.similar_components(documents(awkward)).collect()
    assert len(rows) == len(awkward)
    expected = brute_components(awkward)
    for r in rows:
        assert r.component_id == (expected[r.doc_id] if r.doc_id is not None else None)
    assert {r.n_shingles for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert group_join.similar_components(documents([])).count() == 0


def test_connected_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 540)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(chain + star + [(900, 7), (7, 900), (3, 3)], "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 540)}, 900: 7, 7: 7}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_removed(pairs, n=20):
    """Per id: words, removed, kept text; ids must be distinct."""
    seen, out = set(), {}
    for i, t in sorted(pairs):
        w = WORD.findall(t or "")
        hit = set()
        for s in range(len(w) - n + 1):
            key = tuple(w[s : s + n])
            if key in seen:
                hit.update(range(s, s + n))
            seen.add(key)
        out[i] = (len(w), len(hit), " ".join(x for k, x in enumerate(w) if k not in hit))
    return out


def check_removed(df, pairs, **settings):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in seed_extend.deduplicate(df, **settings).collect()}
    assert got == brute_removed(pairs, settings.get("min_words", 20))


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_words_match_brute_force(documents, seed):
    check_removed(documents(corpus(seed)), corpus(seed))


def test_repeats_inside_one_text_and_few_words(documents):
    rng = random.Random(6)
    passage = words(rng, 25)
    pairs = [
        (1, passage + " x " + passage + " y " + passage),
        (2, "a b " * 100),  # overlapping equal windows
        (3, " ".join(rng.choice("ab") for _ in range(400))),
        (4, passage[: passage.rindex(" ")] + " z"),
        (5, "same " * 300),
        (6, "same " * 19),
        (7, "same " * 20),
    ]
    check_removed(documents(pairs), pairs)
    check_removed(documents(pairs), pairs, min_words=9, gram=4)


def test_small_buckets_remove_the_same(documents, monkeypatch):
    monkeypatch.setattr(seed_extend, "BUCKET_ENTRIES", 25)
    pairs = corpus(7, 90)
    check_removed(documents(pairs).repartition(4), pairs)


def test_substring_defined_results(documents, awkward):
    rows = seed_extend.deduplicate(documents(awkward), carry=["text", "kept", "n"]).collect()
    assert len(rows) == len(awkward)
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].n_words, by_id[i].n_removed, by_id[i].kept) == (0, 0, "")
    for r in rows:
        if r.doc_id is None and r.n_words:
            assert r.n_removed == 0  # a row without id repeats nothing
        assert r.n_removed == sum(s.high - s.low for s in r.spans)
        assert (r.carried.kept, r.carried.n) == ("x", 2)
    assert {r.n_removed for r in rows if r.doc_id == 7} == {0}  # alike rows are one document
    assert by_id[9].kept == "A b"
    assert by_id[15].n_removed == by_id[15].n_words - brute_removed([(1, by_id[6].carried.text), (2, by_id[15].carried.text)])[2][0] + brute_removed(
        [(1, by_id[6].carried.text), (2, by_id[15].carried.text)])[2][1]
    assert seed_extend.deduplicate(documents([])).count() == 0


def test_one_id_with_two_texts_compares_one_of_them(documents):
    rng = random.Random(8)
    a, b = words(rng, 50), words(rng, 50)
    rows = seed_extend.deduplicate(documents([(1, a), (1, b), (2, a), (3, b)])).collect()
    removed = sorted((r.doc_id, r.n_removed) for r in rows)
    assert removed[:2] == [(1, 0), (1, 0)] and sorted(n for _, n in removed[2:]) == [0, 50]


def test_packed_entries_count_each_key_once():
    import numpy as np

    keys = np.array([5, 7, 5, 9], np.uint64)
    owners = np.array([1, 1, 2, 3])
    distinct, owner, repeated = packed.shared_here(keys, owners)
    assert distinct.tolist() == [5, 7, 9] and owner.tolist() == [packed.SEVERAL, 1, 3] and repeated.tolist() == [True, False, True, False]
    both = np.concatenate([distinct, np.array([7, 11], np.uint64)])
    assert packed.shared_of_all(both, np.concatenate([owner, [4, packed.SEVERAL]])).tolist() == [False, True, False, True, False]
    held = dict(packed.by_bucket(both, 2, np.arange(5)))
    assert list(held) == [1] and len(held[1][0]) == 40
    assert dict(packed.by_bucket(both[:0], 2)) == {}
