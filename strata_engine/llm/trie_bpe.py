"""Word-level BPE by a trie of the distinct words.

A BPE encoding is decided pair by pair: a sequence of tokens is the encoding
of its text exactly if every two neighbours stay apart, that is if BPE over
the two alone gives the two. So every prefix of a word has one encoding, and
it is that of a shorter prefix plus one last token; the last token is the
only token that ends the prefix and stays apart from the last token of what
lies before it.

The distinct words of a slice of texts go into a trie. A depth-first walk
keeps the last token of every prefix on the path from the root, so words that
begin alike share the states of what they have in common, each computed once.
At a word's end its last character is taken with the end-of-word mark, and
the encoding is read backwards off the path.

The tokenizer file's own normalizer, pre-tokenizer and special tokens apply;
the library never sees whole texts, only their distinct words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from strata_engine.llm.common import arrow_schema, begin, give_back, keeps, named, slices

# Words, pre-tokens, pairs of tokens and trie nodes that a Python worker keeps
# between slices; they trade memory for time, nothing else.
CACHED_WORDS = 200_000
CACHED_PIECES = 200_000
CACHED_PAIRS = 400_000
TRIE_NODES = 300_000
# Pre-tokens inserted between two looks at the trie's size.
PIECE_BLOCK = 5_000
# Words given to the pre-tokenizer at once.
JOINED_WORDS = 2_000
# Bytes of text whose words are looked up together.
SLICE = 2_000_000
CODE_POINTS = 1 << 21

# The normalizer and pre-tokenizer for which it is plain how an
# ASCII word of signs, letters and signs comes apart (no apostrophes, as those
# may belong to a contraction). With any other the library is asked.
PLAIN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*"""
PLAIN_WORD = re.compile(rf"({SIGNS})([A-Za-z]+)({SIGNS})")


class Merges:
    """The BPE model of a tokenizer file: which token ends a prefix."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a plain BPE model is needed")
        if model.get("continuing_subword_prefix"):
            raise ValueError("tokens that continue a word must not be marked")
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        # symbols of each token: what merging begins with
        self.symbols = {i: (i,) for i in self.ids.values()}
        self.inner = {t: i for t, i in self.ids.items() if len(t) == 1}
        self.final = {t: self.ids[t + self.end] for t in self.inner if t + self.end in self.ids}
        finals = set(self.final.values()) if self.end else set()
        text = {i: t for t, i in self.inner.items()} | ({i: t for t, i in self.final.items()} if self.end else {})
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank.setdefault((left, right), (rank, made))
            self.symbols[made] = self.symbols[left] + self.symbols[right]
            text[made] = text[left] + text[right]
            if right in finals:
                finals.add(made)
                self.final[text[made]] = made
            else:
                self.inner[text[made]] = made
        if not self.end:
            self.final = self.inner
        self.longest = max(map(len, text.values()), default=1)
        self._apart: dict[tuple[int | None, int], bool] = {}
        self.known = self._apart.get

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """Plain BPE: the pair of lowest rank, leftmost first, is merged until
        no pair is left."""
        found = list(symbols)
        while len(found) > 1:
            best = min((self.rank[p] + (i,) for i, p in enumerate(zip(found, found[1:])) if p in self.rank), default=None)
            if best is None:
                break
            at = best[2]
            found[at : at + 2] = [best[1]]
        return found

    def apart(self, before: int | None, token: int) -> bool:
        """Do the two tokens stay apart (None: is the token whole by itself)?"""
        key = (before, token)
        known = self._apart.get(key)
        if known is None:
            if before is None:
                known = self.merged(self.symbols[token]) == [token]
            else:
                known = key not in self.rank and self.merged(self.symbols[before] + self.symbols[token]) == [before, token]
            if len(self._apart) >= CACHED_PAIRS:
                self._apart.clear()
            self._apart[key] = known
        return known


class Trie:
    """Prefixes of words, character by character, each with its state: the
    last token and how many characters that has. A word's last character is
    no node, as it is encoded with the end-of-word mark."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.below: dict[int, int] = {}  # node * CODE_POINTS + character -> node
        self.tokens: list[int | None] = [None]  # of each node; the root has none
        self.sizes = [0]

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """{word: ids}. The words are inserted in sorted order, which walks
        the trie depth first: the path from the root down to where a word
        leaves the one before it stays, and only prefixes that no word had
        before get a state of their own."""
        merges, below, longest = self.merges, self.below, self.merges.longest
        inner, final, known, apart = merges.inner.get, merges.final.get, merges.known, merges.apart
        all_tokens, all_sizes = self.tokens, self.sizes
        nodes, tokens, sizes = [0], [None], [0]  # along the path, by length of the prefix
        out, before = {}, ""
        for word in sorted(words):
            n = len(word)
            shared, most = 0, min(len(nodes), n) - 1
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del nodes[shared + 1 :], tokens[shared + 1 :], sizes[shared + 1 :]
            for depth in range(shared + 1, n + 1):
                if depth < n:
                    edge = nodes[-1] * CODE_POINTS + ord(word[depth - 1])
                    node = below.get(edge)
                    if node is not None:
                        nodes.append(node)
                        tokens.append(all_tokens[node])
                        sizes.append(all_sizes[node])
                        continue
                ends = inner if depth < n else final
                for at in range(max(0, depth - longest), depth):
                    token = ends(word[at:depth])
                    if token is not None:
                        fits = known((tokens[at], token))
                        if apart(tokens[at], token) if fits is None else fits:
                            break
                else:
                    raise ValueError(f"the vocabulary has no tokens for {word[:depth]!r}")
                if depth < n:
                    below[edge] = len(all_tokens)
                    nodes.append(len(all_tokens))
                    tokens.append(token)
                    sizes.append(depth - at)
                    all_tokens.append(token)
                    all_sizes.append(depth - at)
            ids = [token]
            while at:
                ids.append(tokens[at])
                at -= sizes[at]
            ids.reverse()
            out[word] = ids
            before = word
        return out


def _comes_apart_plainly(spec: dict) -> bool:
    normalizer, splitter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    kinds = [x.get("type") for x in normalizer.get("normalizers", [])]
    steps = splitter.get("pretokenizers", [])
    if kinds != PLAIN_NORMALIZERS or [x.get("type") for x in steps] != ["Split", "ByteLevel"]:
        return False
    split, level = steps
    whole = split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]
    return whole and split["pattern"] == {"Regex": PLAIN_PATTERN} and normalizer["normalizers"][1]["pattern"] == {"Regex": "\\s+"}


class TrieEncoder:
    """Ids of texts as the tokenizer file has them. Words (runs without ASCII
    white space) must not influence each other: true of normalizers and
    pre-tokenizers that drop white space."""

    def __init__(self, path: str, special_tokens: bool = True):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec["model"])
        self.trie = Trie(self.merges)
        self.plain_word = PLAIN_WORD.fullmatch if _comes_apart_plainly(spec) else lambda word: None
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        added = tokenizer.get_added_tokens_decoder() if special_tokens else {}
        if any(t.normalized or t.single_word for t in added.values()):
            raise ValueError("special tokens must be matched as they stand")
        self.special = {t.content: i for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _pre_tokens(self, text: str) -> list[tuple[str, int]]:
        """(pre-token, where it begins in the normalized text)."""
        return [(piece, span[0]) for piece, span in self.pre_tokenizer.pre_tokenize_str(text)]

    def _normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text) if self.normalizer is not None else text

    def _parts(self, words: list[str]) -> dict[str, list[str | int]]:
        """Pre-tokens and special ids of each word, in order."""
        out: dict[str, list[str | int]] = {}
        special = self.special_pattern
        asked = []
        for w in words:
            if special is None or not special.search(w):
                if found := self.plain_word(w):
                    head, stem, tail = found.groups()
                    out[w] = [x for x in (head, stem.lower(), tail) if x]
                else:
                    asked.append(w)
        plain = asked
        for i in range(0, len(plain), JOINED_WORDS):
            some = plain[i : i + JOINED_WORDS]
            joined = self._normal(" ".join(some))
            begins = np.array([0, *(k + 1 for k, c in enumerate(joined) if c == " ")])
            if len(begins) == len(some):
                found = self._pre_tokens(joined)
                of = np.searchsorted(begins, [at for _, at in found], "right") - 1 if found else []
                out.update((w, []) for w in some)
                for (piece, _), k in zip(found, of):
                    out[some[k]].append(piece)
            else:  # some word holds other white space
                out.update((w, [piece for piece, _ in self._pre_tokens(self._normal(w))]) for w in some)
        for w in set(words).difference(out):
            parts: list[str | int] = []
            for text in special.split(w):
                if text in self.special:
                    parts.append(self.special[text])
                elif text:
                    parts += [piece for piece, _ in self._pre_tokens(self._normal(text))]
            out[w] = parts
        return out

    def _encode_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens by the trie; a full one is given up
        before the next block of pieces."""
        out: dict[str, bytes] = {}
        some = sorted(pieces)  # blocks of neighbours share most prefixes
        for i in range(0, len(some), PIECE_BLOCK):
            if len(self.trie.tokens) > TRIE_NODES:
                self.trie = Trie(self.merges)
            for word, ids in self.trie.encode(some[i : i + PIECE_BLOCK]).items():
                out[word] = np.array(ids, "<u4").tobytes()
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        parts = self._parts(words)
        new = {p for found in parts.values() for p in found if isinstance(p, str)}.difference(self.pieces)
        learned = self._encode_pieces(new)
        ids = lambda p: learned[p] if p in learned else self.pieces[p]
        out = {w: b"".join([ids(p) if isinstance(p, str) else np.uint32(p).astype("<u4").tobytes() for p in found]) for w, found in parts.items()}
        if len(self.pieces) < CACHED_PIECES:
            self.pieces.update(learned)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's end);
        a null text has none."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        numbered = lists.flatten().dictionary_encode()
        words, number = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        learned = self._learn([w for w in words if w and w not in self.words])
        learned[""] = b""
        data = [learned[w] if w in learned else self.words[w] for w in words]
        if len(self.words) < CACHED_WORDS:
            self.words.update(learned)
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        starts = np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        at = np.repeat(starts[number] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(data), "<u4")[at]
        return ids, np.append(0, ends)[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]


@lru_cache(maxsize=1)
def _encoder(path: str, special_tokens: bool) -> TrieEncoder:
    keeps("trie_bpe", _encoder.cache_clear)
    return TrieEncoder(path, special_tokens)


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_tokens: bool = True,
    packed: bool = False,
) -> DataFrame:
    """doc_id, ids: the ids of every whole text by the tokenizer file at
    ``path`` (no special tokens added; truncation and padding unused). ids
    is an array<int>, or with ``packed`` a binary of little-endian unsigned
    32-bit ids. The strings of special tokens in a text become those tokens,
    as in the library's plain call; without ``special_tokens`` they are
    ordinary text. Null and empty texts have no ids. Map only, any id type,
    repeated rows stay; other columns are ignored."""
    src = named(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids {'binary' if packed else 'array<int>'}"
    target = arrow_schema(schema)

    def run(batches):
        begin("trie_bpe")
        encoder = _encoder(path, special_tokens)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                flat, ends = encoder.encode(part.column("text"))
                bounds = np.append(0, ends)
                if packed:
                    buffers = [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(flat.tobytes())]
                    ids = pa.Array.from_buffers(pa.binary(), part.num_rows, buffers)
                else:
                    ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view("<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(target.field("doc_id").type), ids.cast(target.field("ids").type)], schema=target
                )
        give_back()

    return src.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Columns doc_id and ids (either form of :func:`encode`) and text: what
    the tokenizer file's decoder makes of the ids, special tokens included.
    Without a decoder that is the tokens joined by one space. Ids that are
    no tokens are left out; null ids give a null text."""
    packed = isinstance(encoded.schema["ids"].dataType, BinaryType)
    src = encoded.select("doc_id", "ids")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema) + ", text string"
    target = arrow_schema(schema)

    def run(batches):
        begin("trie_bpe")
        table, whole = _token_table(path)
        for batch in batches:
            for part in slices(batch, "ids") if packed else [batch]:
                ids = part.column("ids")
                if packed:
                    per_row = [None if x is None else np.frombuffer(x, "<u4") for x in ids.to_pylist()]
                else:
                    per_row = [None if x is None else np.array(x, np.int64) for x in ids.to_pylist()]
                if whole is not None:
                    text = [None if x is None else whole(x.tolist()) for x in per_row]
                else:
                    text = _joined(per_row, table)
                columns = [part.column(c).cast(target.field(c).type) for c in ("doc_id", "ids")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(text, pa.string())], schema=target)
        give_back()

    return src.mapInArrow(run, schema)


def _joined(per_row: list[np.ndarray | None], table: pa.Array) -> list[bytes | None]:
    """Each row's tokens joined by one space; ``table``: id -> token with a
    space behind it, the empty string for ids without token."""
    lengths = [0 if x is None else len(x) for x in per_row]
    flat = np.concatenate([np.zeros(0, np.int64), *(x.astype(np.int64) for x in per_row if x is not None)])
    known = (flat >= 0) & (flat < len(table) - 1)
    taken = table.take(pa.array(np.where(known, flat, len(table) - 1)))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
    blob = taken.buffers()[2].to_pybytes() if len(taken) else b""
    ends = np.cumsum([0, *lengths])
    bounds = offsets[ends].tolist() if len(taken) else [0] * len(ends)
    return [None if x is None else blob[a : max(a, b - 1)] for x, a, b in zip(per_row, bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _token_table(path: str):
    """(id -> token and a space, last entry empty; the library's own decode
    if the file has a decoder, else None)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.decoder is not None:
        return None, lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    names = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    held = [f"{names[i]} " if i in names else "" for i in range(max(names, default=-1) + 1)]
    return pa.array([*held, ""], pa.large_string()), None
