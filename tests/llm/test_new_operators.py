"""Filter audit, trie BPE, fill in the middle: brute force and round trips."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from strata_engine.llm import filter_audit, fim_wavelet, trie_bpe
from strata_engine.llm import queries as Q

from .conftest import words
from .test_tokens_archives import awkward_runs

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_lehmer_rank_is_the_position_among_all_permutations():
    for n in (1, 3, 5):
        for rank, order in enumerate(permutations(range(n))):
            assert filter_audit.lehmer_rank(order, n) == rank
            for k in range(n):
                first = next(r for r, p in enumerate(permutations(range(n))) if p[:k] == order[:k])
                assert filter_audit.lehmer_rank(order[:k], n) == first


def brute_cells(masks: Counter, letters: str):
    """(order, step) -> kept, removed, redundant, alone by walking every order."""
    out = {}
    for order in permutations(letters):
        left = dict(masks)
        for step, f in enumerate(order, 1):
            removed = sum(n for m, n in left.items() if f in m)
            left = {m: n for m, n in left.items() if f not in m}
            failing = sum(n for m, n in masks.items() if f in m)
            out["".join(order), step] = (sum(left.values()), removed, failing - removed, masks.get(f, 0))
    return out


@pytest.mark.parametrize("letters", ["A", "AB", "BDFX"])
def test_audit_of_counts_equals_walking_every_order(spark, letters):
    rng = random.Random(len(letters))
    rows, parts = [], {"": Counter(), "p": Counter(), "q": Counter()}
    for part, held in parts.items():
        for _ in range(9 if part != "q" else 1):
            mask = rng.randrange(1 << len(letters)) if part != "q" else 0
            n = rng.randrange(1, 50)
            rows.append((part, mask, n, n // 2))
            held["".join(x for i, x in enumerate(letters) if mask >> i & 1)] += n
    counts = spark.createDataFrame(rows, "part string, mask int, n bigint, odd bigint")
    got = filter_audit.audit(counts, letters, ("odd",)).collect()
    assert len(got) == 3 * len(list(permutations(letters))) * len(letters)
    taken = Counter()
    for r in got:
        taken[r.part, r.filter_order[r.step - 1]] += r.removed
    for part, held in parts.items():
        expected = brute_cells(held, letters)
        mine = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails) for r in got if r.part == part}
        assert mine == expected
    assert all(r.shapley == taken[r.part, r.filter_order[r.step - 1]] and 2 * r.odd_lost <= r.removed for r in got)


def test_audit_refuses_what_it_cannot_rank(spark):
    counts = spark.createDataFrame([], "part string, mask int, n bigint")
    for letters in ("BA", "AA", "ABCDEFG", ""):
        with pytest.raises(ValueError):
            filter_audit.audit(counts, letters)
    assert filter_audit.audit(counts, "AB").count() == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_mask(doc_id, text, docs):
    t, w = text or "", words_of(text)
    out = "A" if len(w) < 50 else ""
    out += "B" if 100 * len(set(w)) < 65 * len(w) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else ""
    out += "D" if re.search(r"[#$%&*|]", t) else ""
    return out + ("E" if doc_id is not None and any(i is not None and i < doc_id and (u or "") == t for i, u, _ in docs) else "")


def test_audit_of_documents_equals_brute_force(spark, documents, awkward):
    rng = random.Random(4)
    sources = [None, "", "web", "b"]
    docs = [(i, t, rng.choice(sources)) for i, t in awkward]
    base = " ".join(f"w{k}" for k in range(60))
    docs += [(100 + k, rng.choice([base, base + " A#", "X Y Z", base.upper(), base + " w1" * 40]), rng.choice(sources)) for k in range(60)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in docs if rng.random() < 0.7] + [(None, 1, 1)]
    frame = documents([(i, t) for i, t, _ in docs], source=[s for _, _, s in docs])
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    held = Counter()
    for i, t, s in docs:
        held[s or "", brute_mask(i, t, docs), i in good, i in toxic] += 1
    got = filter_audit.audit_documents(frame, marks).collect()
    assert len(got) == 600 * len({k[0] for k in held})
    for r in got:
        f, before = r.filter_order[r.step - 1], set(r.filter_order[: r.step - 1])
        here = {k: n for k, n in held.items() if k[0] == r.part}
        hit = {k: n for k, n in here.items() if f in k[1] and not before & set(k[1])}
        assert r.removed == sum(hit.values()) and r.kept == sum(n for k, n in here.items() if not (before | {f}) & set(k[1]))
        assert r.good_lost == sum(n for k, n in hit.items() if k[2]) and r.toxic_lost == sum(n for k, n in hit.items() if k[3])
        assert r.redundant == sum(n for k, n in here.items() if f in k[1] and before & set(k[1]))
        assert r.unique_fails == sum(n for k, n in here.items() if k[1] == f)


def test_wavelet_matrix_counts_and_selects():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 9, 300):
        codes = rng.integers(0, 6, size).astype(np.uint8)
        matrix = fim_wavelet.WaveletMatrix(codes, 3)
        ends = np.arange(size + 1)
        for wanted in ((0,), (5,), (1, 2, 4), (7,)):
            held = np.isin(codes, wanted)
            assert matrix.count(wanted, ends).tolist() == np.append(0, np.cumsum(held)).tolist()
            places = np.flatnonzero(held)
            assert matrix.select(wanted, np.arange(len(places) + 1)).tolist() == [*places.tolist(), size]


def brute_units(text, unit):
    """Where each unit begins, in code points."""
    space = " \t\n\v\f\r"
    if unit == "code_point":
        return list(range(len(text)))
    if unit == "word":
        return [i for i, c in enumerate(text) if c not in space and (i == 0 or text[i - 1] in space)]
    return [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]


def brute_fim(doc_id, text, unit, plain, spm):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    text = text or ""
    begins = brute_units(text, unit)
    n = len(begins)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = lambda k: 0 if k == 0 else len(text) if k == n else begins[k]
    x, y, z = text[: at(a)], text[at(a) : at(b)], text[at(b) :]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("unit, plain, spm", [("code_point", 10, 20), ("word", 0, 50), ("line", 30, 100)])
def test_fill_in_middle_equals_brute_force(documents, awkward, unit, plain, spm):
    rng = random.Random(9)
    docs = awkward + [(50, "a<P>b"), (51, "<S>"), (52, "x <M"), (53, "<P <S <M>")]
    docs += [(1000 + i, "".join(rng.choice("aé中😀 \n<PSM>") for _ in range(rng.randrange(60)))) for i in range(300)]
    made = fim_wavelet.transform(documents(docs), unit=unit, plain_percent=plain, spm_percent=spm)
    rows = fim_wavelet.restore(made).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in rows) == Counter(
        (i, *brute_fim(i, t, unit, plain, spm)) for i, t in docs
    )
    assert Counter((r.doc_id, r.restored) for r in rows) == Counter((i, t or "") for i, t in docs)
    assert {"psm", "spm", "plain"} >= {r.form for r in rows} and len({r.form for r in rows}) > 1
    assert fim_wavelet.transform(documents([])).count() == 0


def test_fill_in_middle_cuts_many_texts_of_one_slice_and_refuses_other_units(documents):
    text = "über alles\nund é " * 9_000  # many slices' worth in one batch
    docs = [(i, text[i:]) for i in range(12)]
    rows = fim_wavelet.transform(documents(docs, extra=False).repartition(1)).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in rows) == Counter(
        (i, *brute_fim(i, t, "code_point", 10, 20)) for i, t in docs
    )
    with pytest.raises(ValueError):
        fim_wavelet.transform(documents([]), unit="token")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def odd_texts():
    rng = random.Random(31)
    special = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    out = ["Stop. stop, STOP., it's, 1. 2, é. İ. K, ß.", "́a é, Å. Å", "Σας ΟΔΟΣ. ΟΔΟΣ", "a b c\x85d\x1ce", "it's we'LL <|endoftext|>'s"]
    out += ["".join(rng.choice([*special, *"aAé.'s 1\n中"]) for _ in range(40)) for _ in range(200)]
    out += ["".join(rng.choice("abcdefghinorst.,'!12é") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    return out + awkward_runs()


def test_trie_ids_equal_the_tokenizers_plain_call(documents, awkward, tokenizer):
    texts = awkward + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    expected = Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        expected[i, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert any(49407 in k[1] for k in expected)
    for packed in (False, True):
        rows = trie_bpe.decode(trie_bpe.encode(documents(texts), WORDS, packed=packed), WORDS).collect()
        ids = lambda r: np.frombuffer(bytes(r.ids), "<u4").tolist() if packed else r.ids  # noqa: E731, B023
        assert Counter((r.doc_id, tuple(ids(r)), r.text) for r in rows) == expected
    assert trie_bpe.decode(trie_bpe.encode(documents([]), WORDS), WORDS).count() == 0


def test_special_strings_can_be_ordinary_text(tokenizer):
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    encoder = trie_bpe.TrieEncoder(WORDS, special_tokens=False)
    texts = odd_texts()
    ids, ends = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_caches_and_small_tries_change_nothing(tokenizer, monkeypatch):
    for name, value in (("CACHED_WORDS", 5), ("CACHED_PIECES", 3), ("CACHED_PAIRS", 7), ("TRIE_NODES", 20), ("PIECE_BLOCK", 3), ("JOINED_WORDS", 2)):
        monkeypatch.setattr(trie_bpe, name, value)
    encoder = trie_bpe.TrieEncoder(WORDS)
    texts = [*odd_texts()[:60], None, ""]
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(["skipped", *texts])[1:])
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_shared_prefixes_are_computed_once(tokenizer):
    encoder = trie_bpe.TrieEncoder(WORDS)
    shared = "internationaliz"
    some = [shared + x for x in ("ed", "es", "ing", "ation", "ations")]
    trie = trie_bpe.Trie(encoder.merges)
    got = trie.encode(some)
    assert len(trie.tokens) == 1 + len({w[:k] for w in some for k in range(1, len(w))})
    assert got == {w: tokenizer.encode(w, add_special_tokens=False).ids for w in some}
    more = [shared + "er", "international", "i"]
    assert trie.encode(more) == {w: tokenizer.encode(w, add_special_tokens=False).ids for w in more}
    assert len(trie.tokens) == 1 + len({w[:k] for w in some + more for k in range(1, len(w))})


def test_trie_on_random_vocabularies():
    """Any merge list learned in order: the trie equals plain BPE."""
    rng = random.Random(17)
    for trial in range(60):
        alphabet = "abc"[: rng.randint(2, 3)]
        vocab = {x: i for i, x in enumerate([*alphabet, *(c + "</w>" for c in alphabet)])}
        merges, tokens = [], list(vocab)
        for _ in range(rng.randint(1, 14)):
            a, b = rng.choice([t for t in tokens if not t.endswith("</w>")]), rng.choice(tokens)
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                tokens.append(a + b)
                merges.append((a, b))
        plain = Tokenizer(models.BPE(vocab, merges, end_of_word_suffix="</w>"))
        model = trie_bpe.Merges({"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": "</w>"})
        # tokens that their own merges do not give are never reached
        some = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(80)}
        assert trie_bpe.Trie(model).encode(some) == {w: plain.encode(w).ids for w in some}, trial


def test_decoding_odd_ids_and_files_with_a_decoder(spark, tokenizer, tmp_path):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, 49407, 10**6, 530, -1]), (4, [-1])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in trie_bpe.decode(df, WORDS).collect()}
    assert got == {1: None, 2: "", 3: tokenizer.decode([320, 49407, 530], skip_special_tokens=False), 4: ""}
    other = Tokenizer(models.BPE({"a": 0, "b": 1, "a</w>": 2, "b</w>": 3, "ab</w>": 4}, [("a", "b</w>")], end_of_word_suffix="</w>"))
    other.pre_tokenizer, other.decoder = pre_tokenizers.Whitespace(), decoders.BPEDecoder()
    other.save(str(tmp_path / "t.json"))
    docs = spark.createDataFrame([(1, "ab ba b")], "doc_id bigint, text string")
    made = trie_bpe.decode(trie_bpe.encode(docs, str(tmp_path / "t.json")), str(tmp_path / "t.json")).first()
    assert made.ids == other.encode("ab ba b").ids and made.text == other.decode(made.ids)
    spec = json.loads((tmp_path / "t.json").read_text())["model"]
    for change in ({"type": "WordPiece"}, {"dropout": 0.1}, {"continuing_subword_prefix": "##"}):
        with pytest.raises(ValueError):
            trie_bpe.Merges(spec | change)


def test_query_op12_equals_the_library(spark, tmp_path, tokenizer):
    rng = random.Random(2)
    docs = [(i, words(rng, rng.randrange(80)) + rng.choice(["", " <|endoftext|> x", " É'S"])) for i in range(60)] + [(99, None)]
    for name, schema in (("documents", "doc_id bigint, text string"),):
        spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for r in Q.QUERIES["op12_word_bpe"](spark, str(tmp_path)).collect():
        ids = tokenizer.encode(dict(docs)[r.doc_id] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
