from __future__ import annotations

import random

import pytest

# Columns whose names meet the operators' own.
CLASHING = {
    "id": 1, "n": 2, "row": 3, "chunk": 4, "piece": 5, "length": 6, "rank": 7, "bucket": 8, "fp": b"9", "kept": "x",
    "verdict": True, "text_copy": "y", "carried": 1, "shard": 1, "score": 0.5, "token": 1, "tokens": 2, "payload": "z", "digest": "d",
}


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture()
def documents(spark):
    """documents-like table from (doc_id, text) pairs, with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(pairs, extra=True, **columns):
        names = ["doc_id", "text", *columns]
        rows = [(i, t, *(columns[c][k] for c in columns)) for k, (i, t) in enumerate(pairs)]
        kinds = {"lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}
        schema = "doc_id bigint, text string" + "".join(f", {c} {kinds[c]}" for c in columns)
        df = spark.createDataFrame(rows, schema).select(*names)
        return df.withColumns({c: F.lit(v) for c, v in CLASHING.items()}) if extra else df

    return make


@pytest.fixture(scope="session")
def awkward() -> list[tuple[int | None, str | None]]:
    """Null ids and texts, empty, blank, one-word, huge-word and very long
    texts, repeated rows, and copies."""
    rng = random.Random(5)
    base = words(rng, 120)
    long = words(rng, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, "x" * 50_000), (6, long), (7, base), (7, base),
        (8, base.upper()), (9, base + "\nA b"), (None, base), (None, None), (10, "a b c d"), (11, "a b c d"), (12, "ä ö ü é ñ"),
        (13, "\U0001f600 " * 400), (14, "\n".join(["same line here"] * 30)), (15, long[:200_000]), (16, "0 1 2 3 4 5"),
        (17, "<|endoftext|> it's don't, <|startoftext|>."), (18, "a\x00b \x00 c\x85d"), (19, "tab\tnew\nline  two   three    "),
    ]
