"""Token ids of whole texts by a word-level BPE tokenizer file.

The tokenizer drops white space and never merges across it, so a text's ids
are those of its words in order. Words recur, so a worker keeps the ids of the
words it has met (up to a bound) and asks the tokenizer only for new ones.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, begin, give_back, keeps, named, slices

# Words whose ids a Python worker keeps; beyond that they are asked for anew.
MAX_CACHED_WORDS = 600_000
# ASCII signs that the tokenizer's pattern takes as one run (an apostrophe
# may belong to a contraction).
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Bytes of text whose words are looked up together.
SLICE = 2_000_000


class WordEncoder:
    """Ids of texts, with a cache by word."""

    def __init__(self, path: str, cached_words: int = MAX_CACHED_WORDS):
        from tokenizers import Tokenizer

        self.cached_words = cached_words

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        mark = self._ask(["\0"])[0]
        # between two marks stand the ids of one word; none holds a mark itself
        self.mark = int(np.frombuffer(mark, "<u4")[0]) if len(mark) == 4 else None

    def _ask(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        plain = [w for w in words if w and "\0" not in w] if self.mark is not None else []
        odd = list(set(words).difference(plain))
        out = dict(zip(odd, self._ask(odd))) if odd else {}
        for i in range(0, len(plain), 2_000):
            part = plain[i : i + 2_000]
            ids = np.frombuffer(self._ask([" \0 ".join(part)])[0], "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) != len(part):  # not a tokenizer that takes marks apart: word by word
                out.update(zip(part, self._ask(part)))
                continue
            data, start = ids.tobytes(), 0
            for w, end in zip(part, ends.tolist()):
                out[w] = data[4 * start : 4 * end]
                start = end + 1
        return out

    def _learn_all(self, new: set[str]) -> dict[str, bytes]:
        """Ids of new words. Signs that end a word after an ASCII letter are
        one pre-token of their own: such a word is the word without them,
        then the signs."""
        ends = {}
        for w in new:
            stem = w.rstrip(SIGNS)
            if len(stem) < len(w) and "a" <= stem[-1:] <= "z" and not any(x in w for x in self.special):
                ends[w] = (stem, w[len(stem) :])
        plain = new.difference(ends).union(*ends.values()).difference(self.cache)
        learned = self._learn(list(plain)) if plain else {}
        for w, parts in ends.items():
            learned[w] = b"".join([learned[x] if x in learned else self.cache[x] for x in parts])
        return learned

    def _case_matters(self, texts: pa.StringArray) -> bool:
        marks = pc.match_substring(texts.cast(pa.binary()), b"\xcc")  # how U+0300 to U+033F begin
        found = [marks, *(pc.match_substring(texts, x, ignore_case=True) for x in self.special)]
        return any(pc.any(f).as_py() for f in found)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's end).
        Words are split, lower-cased and numbered by Arrow; only the distinct
        ones of ``texts`` become Python objects. ASCII case and white space do
        not matter to the tokenizer, but for the strings of special tokens,
        which are matched as they stand, and for letters that a combining
        mark follows."""
        texts = pc.fill_null(texts, "")
        if self._case_matters(texts):
            lists = pc.ascii_split_whitespace(texts)
            words = lists.flatten()
            as_it_is = pc.invert(pc.string_is_ascii(words))
            for x in self.special:
                as_it_is = pc.or_(as_it_is, pc.match_substring(words, x, ignore_case=True))
            words = pc.if_else(as_it_is, words, pc.ascii_lower(words))
        else:
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
            words = lists.flatten()
        numbered = words.dictionary_encode()
        words, number = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        known = self.cache
        learned = self._learn_all(set(words).difference(known))
        known.update(learned)
        data = list(map(known.__getitem__, words))
        if len(known) > self.cached_words:
            for w in learned:
                del known[w]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        starts = np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        # ids of the k-th word: sizes[k] places from starts[k] on
        at = np.repeat(starts[number] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(data), "<u4")[at]
        last = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        return ids, np.append(0, ends)[last]


@lru_cache(maxsize=1)
def _encoder(path: str, cached_words: int) -> WordEncoder:
    keeps("word_bpe", _encoder.cache_clear)
    return WordEncoder(path, cached_words)


def token_pieces(
    docs: DataFrame,
    path: str,
    max_tokens: int,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    cached_words: int = MAX_CACHED_WORDS,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, unless ``with_ids`` is
    off, ids (array<int>): the ids of every whole text, then ``end_id``; only
    longer ones are cut, into pieces of ``max_tokens``. A null or empty text
    is one piece holding ``end_id``. The strings of special tokens become those
    tokens, as in the library's plain call. The tokenizer must lower-case and
    drop white space; other columns are ignored. ``cached_words`` and
    ``slice_bytes`` trade a worker's memory for time, nothing else."""
    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""
    target = arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        begin("word_bpe")
        encode = _encoder(path, cached_words).encode
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                found, ends = encode(part.column("text"))
                for row, (a, b) in enumerate(zip(np.append(0, ends).tolist(), ends.tolist())):
                    data = found[a:b].tobytes() + end
                    for n, at in enumerate(range(0, len(data), 4 * max_tokens)):
                        held = data[at : at + 4 * max_tokens]
                        rows.append(row)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(held) // 4)
                        crc.append(zlib.crc32(held))
                        if with_ids:
                            ids.append(np.frombuffer(held, "<u4").astype(np.int32))
                columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), piece, start, length, crc]
                columns += [ids] if with_ids else []
                columns = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)
        give_back()

    return src.mapInArrow(cut, schema)
