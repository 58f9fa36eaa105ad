"""Registered queries and the pipeline on small whole tables: awkward rows,
empty tables, and stages against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata_engine.llm import queries as Q

from .conftest import words
from .test_duplicates import brute_components, brute_removed, corpus
from .test_text_models import brute_stats

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def write(spark, folder, **tables) -> str:
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame(tables.get(name, []), schema)
        df.withColumns({"id": F.lit(1), "token": F.lit("x")}).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def awkward_tables(spark, awkward, tmp_path_factory):
    rng = random.Random(12)
    langs = ["aa", "bb", None]
    docs = [(i, t, rng.choice(langs), "s", None) for i, t in awkward]
    docs += [(1000 + k, t, ("aa", "bb")[k % 2], None, len(t)) for k, (_, t) in enumerate(corpus(3, 60))]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _, _, _ in docs] + [(None, 1, 1), (7, 1, 0)]
    pages = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, None, None), (3, "", ""), (4, "u", "<article><p>x")]
    vectors = [(i, [float(rng.random()) for _ in range(4)], 0) for i in range(60)]
    vectors += [(80, None, None), (None, [1.0] * 4, 1), (81, [], 1), (82, [0.0] * 4, 1), (83, [float("nan")] * 4, 1), (20, [1.0] * 4, 0)]
    return write(spark, tmp_path_factory.mktemp("awkward"), documents=docs, labels=labels, pages=pages, embeddings=vectors), docs


ROWS = {"op1": "documents", "op2": "pages", "op3": "pages", "op4": "documents", "op5": "documents", "op7": "documents", "op8": "documents", "op10": "documents", "op12": "documents", "op13": "documents"}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_on_awkward_rows(spark, awkward_tables, name):
    folder, docs = awkward_tables
    rows = Q.QUERIES[name](spark, folder).collect()
    table = ROWS.get(name.split("_")[0])
    if table:
        assert len(rows) == spark.read.parquet(f"{folder}/{table}.parquet").count()
    if table == "documents":
        assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    if name.startswith(("op1_", "op4_")):
        rest = 0 if name.startswith("op1_") else 2
        m = 5 if name.startswith("op1_") else 4
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == rest) for r in rows if r.doc_id is not None)
        assert all(0 <= r.score <= 1 for r in rows)
    if name.startswith("op8_"):
        stats = Counter((d[0], *brute_stats(d[1])) for d in docs)
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == stats
        assert all(not (r.base_failed and r.kept) for r in rows)
    if name.startswith("op10_"):
        texts = Counter((d[0], hashlib.sha256((d[1] or "").encode()).hexdigest()) for d in docs)
        assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == texts


def test_query_op5_equals_brute_force(spark, tmp_path):
    pairs = corpus(8, 80)
    folder = write(spark, tmp_path / "t", documents=[(i, t, None, None, None) for i, t in pairs])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in Q.QUERIES["op5_substrings"](spark, folder).collect()}
    assert got == {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, (n, k, t) in brute_removed(pairs).items()}


@pytest.mark.parametrize("name", sorted([*Q.QUERIES, "pipeline"]))
def test_query_on_empty_tables(spark, tmp_path, name):
    folder = write(spark, tmp_path / "empty")
    df = E.queries()[name](spark, folder)
    assert df.count() == 0 and len(df.columns) >= 3


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    expected = con.sql(Q.ORACLE[name])
    got = Q.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    at = [expected.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(tuple(r[i] for i in at) for r in expected.fetchall())


def planted(seed=21):
    """Clean texts of two made-up languages, junk, copies, near copies and a
    shared passage; (rows of documents, rows of labels)."""
    rng = random.Random(seed)
    sounds = {"aa": ["tha", "ing", "ent", "ion"], "bb": ["sch", "ung", "keit", "ei"]}
    word = lambda lang: "".join(rng.choices(sounds[lang], k=rng.randint(1, 4)))
    text = lambda lang, n: " ".join(word(lang) + rng.choice(["", "", ",", "."]) for _ in range(n))
    passage = text("aa", 60)
    docs, labels, clean = [], [], []
    for i in range(240):
        lang = ("aa", "bb")[i % 2]
        kind, good = i % 12, 1
        t = text(lang, rng.randint(80, 160))
        if kind == 0:
            t, good = " ".join(w + "$$$" for w in t.split()), 0
        elif kind == 1:
            t, good = t.upper() + "!", 0
        elif kind == 2 and clean:
            t = rng.choice(clean)
        elif kind == 3 and clean:
            w = rng.choice(clean).split()
            w[len(w) // 2] = "other"
            t = " ".join(w)
        elif kind == 4:
            t = t + "\n" + passage + "\n" + text(lang, 30)
        elif kind == 5:
            t, good = "12 34 !!", 0
        if kind > 5:
            clean.append(t)
        docs.append((i, t, lang, "s", len(t)))
        labels.append((i, good, 0))
    return docs, labels


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs, labels = planted()
    folder = write(spark, tmp_path / "p", documents=docs, labels=labels)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "near_duplicates", "repeated_passages", "packing"]
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = frame.columns, [{r.doc_id: r.text for r in frame.collect()}]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, folder)
        path = f"{tmp_path}/stage-{name}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        if n < 4:
            assert frame.columns == columns
            seen.append({r.doc_id: r.text for r in frame.collect()})
    start, good, spoken, single, clean = seen
    quality = {i: q for i, q, _ in labels}
    assert {i for i in start if quality[i] == 1} <= set(good) | {i for i, t in start.items() if brute_stats(t)[0] < 50}
    assert not [i for i in good if quality[i] == 0]
    assert set(spoken) == set(good)  # clean texts stay
    group = brute_components(list(spoken.items()))
    assert set(single) == {i for i in spoken if group[i] == i}
    removed = brute_removed(list(single.items()))
    assert clean == {i: (t if removed[i][1] == 0 else removed[i][2]) for i, t in single.items()}
    assert sum(v[1] for v in removed.values()) > 0 and len(single) < len(spoken)
    held = {}
    for r in frame.collect():
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {r.doc_id for r in frame.collect()} == set(clean)
    for parts in held.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048
    whole = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(key).collect())) == Counter(map(tuple, frame.select(key).collect()))


def test_pipeline_on_awkward_rows(spark, awkward_tables):
    folder, _ = awkward_tables
    rows = corpus_pipeline.run(spark, folder).collect()
    assert all(r.length >= 1 for r in rows)


def test_words_helper_is_deterministic():
    assert words(random.Random(1), 3) == words(random.Random(1), 3)
