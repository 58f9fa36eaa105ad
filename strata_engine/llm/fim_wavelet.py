"""Fill-in-middle transformation, with cuts located by a wavelet matrix.

A text's UTF-8 bytes fall into a few classes (inside a code point, white
space, first of a word, first of a line, ...). A wavelet matrix over the
classes answers how many bytes of one class stand before a position; the
ranks of those classes that begin a unit add up to the number of units that
begin before it. Where the k-th unit begins is found by bisection on that
number, so a cut after k code points, words or lines is a byte position
without the text ever being decoded. One matrix is built for all texts of an
Arrow slice, and all their cuts are searched for at once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import arrow_schema, begin, give_back, named, slices

# Classes of a byte: the codes of the wavelet matrix.
INSIDE = 0  # second to fourth byte of a code point
SPACE = 1  # white space (ASCII)
SPACE_LINE = 2  # white space that is the first of a line
WORD = 3  # first of a word
WORD_LINE = 4  # first of a word and of a line
LETTER = 5  # any other first byte of a code point
CODE_BITS = 3

# Classes whose bytes begin a unit.
UNITS = {
    "code_point": (SPACE, SPACE_LINE, WORD, WORD_LINE, LETTER),
    "word": (WORD, WORD_LINE),
    "line": (SPACE_LINE, WORD_LINE),
}
MARKERS = ("<P>", "<S>", "<M>")


class WaveletMatrix:
    """Rank over a sequence of small codes, vectorised over positions.

    Level by level, from the highest bit, the codes are parted stably into
    those with a 0 and those with a 1; a level keeps its bits, eight to a
    byte, and the number of ones before each byte."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.size, self.bits, self.levels = len(codes), bits, []
        for shift in range(bits - 1, -1, -1):
            bit = (codes >> shift & 1).astype(bool)
            packed = np.append(np.packbits(bit), np.uint8(0))
            ones = np.cumsum(np.bitwise_count(packed), dtype=np.int64)
            before = np.append(0, ones[:-1])
            zeros = self.size - int(ones[-1])
            self.levels.append((packed, before, zeros))
            codes = np.concatenate([codes[~bit], codes[bit]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, ends: np.ndarray) -> np.ndarray:
        byte = ends >> 3
        head = packed[byte] & (0xFF00 >> (ends & 7) & 0xFF).astype(np.uint8)
        return before[byte] + np.bitwise_count(head)

    def rank(self, code: int, ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` codes are ``code``."""
        spans = np.append(0, ends).astype(np.int64)
        for level, (packed, before, zeros) in enumerate(self.levels):
            ones = self._ones(packed, before, spans)
            spans = zeros + ones if code >> (self.bits - 1 - level) & 1 else spans - ones
        return spans[1:] - spans[0]

    def count(self, codes: tuple[int, ...], ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` codes are among ``codes``."""
        return sum((self.rank(c, ends) for c in codes), np.zeros(len(ends), np.int64))

    def select(self, codes: tuple[int, ...], number: np.ndarray) -> np.ndarray:
        """Position of the ``number``-th (from 0) code that is among
        ``codes``, by bisection on the counts; the size if there are fewer."""
        low, high = np.zeros(len(number), np.int64), np.full(len(number), self.size, np.int64)
        for _ in range(self.size.bit_length()):
            middle = (low + high) >> 1
            after = self.count(codes, np.minimum(middle + 1, self.size)) > number
            low, high = np.where(after, low, np.minimum(middle + 1, high)), np.where(after, middle, high)
        return high


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every byte; ``starts``: where a text begins."""
    inside = data & 0xC0 == 0x80
    space = (data == 32) | (data >= 9) & (data <= 13)
    new_line, after_space = np.append(True, data[:-1] == 10), np.append(True, space[:-1])
    starts = starts[starts < len(data)]
    new_line[starts] = after_space[starts] = True
    first = np.where(new_line, WORD_LINE, np.where(after_space, WORD, LETTER))
    return np.where(inside, INSIDE, np.where(space, np.where(new_line, SPACE_LINE, SPACE), first)).astype(np.uint8)


def unit_cuts(texts: pa.Array, unit: str, draws: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Cuts of the texts of a slice: (units of each text; cuts in units, a row
    per array of ``draws``, each ``draw % (units + 1)``; byte positions in the
    last value, rows: begin of the text, its cuts, its end; all bytes). A cut
    stands before the unit of that number; before none, at the begin; after
    all, at the end."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    blob = raw.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if raw is not None else b""
    bounds = ends - ends[0]
    data = np.frombuffer(blob, np.uint8)
    matrix = WaveletMatrix(byte_classes(data, bounds[:-1]), CODE_BITS)
    before = matrix.count(UNITS[unit], bounds)
    n = np.diff(before)
    cuts = np.stack([d % (n + 1) for d in draws]) if len(draws) else np.zeros((0, len(n)), np.int64)
    at = matrix.select(UNITS[unit], (before[:-1] + cuts).ravel()).reshape(cuts.shape)
    at = np.where(cuts == 0, bounds[:-1], np.where(cuts == n, bounds[1:], at))
    return n, cuts, np.concatenate([bounds[None, :-1], at, bounds[None, 1:]]), blob


def draws(id_column: Column, seed: str, count: int = 4) -> list[Column]:
    """``count`` (at most 8) numbers from 0 to 2^32 - 1 drawn for an id: the
    8-digit groups of the hex SHA-256 of ``seed:id``. A null id draws as an
    empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
    unit: str = "code_point",
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per document: doc_id, n (units of the text), form, prefix_units,
    middle_units, output.

    A text is cut at two drawn places into prefix, middle and suffix, each of
    whole ``unit``\\ s (code_point; word: a cut stands before a word; line),
    any of them possibly empty. Form ``psm`` is written as P prefix S suffix
    M middle, ``spm`` as S suffix P prefix M middle (``markers`` are P, S, M),
    ``plain`` as it is. Plain are empty texts, texts that hold a marker (or
    they could not be told apart again), and ``plain_percent`` of the others;
    of what remains ``spm_percent`` are spm. All draws depend on seed and id
    alone (see :func:`draws`), so repeated ids are cut alike if their texts
    are. Null texts are empty; plain rows have null prefix_units and
    middle_units. Map only; other columns are ignored."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    src = named(docs, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h = draws(F.col("doc_id"), seed)
    src = src.select("doc_id", text.alias("text"), *[x.alias(f"h{i}") for i, x in enumerate(h, 1)])
    marked = sum((F.contains("text", F.lit(m)).cast("int") for m in markers), F.lit(0)) > 0
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    src = src.select("doc_id", F.col("text").cast("binary").alias("text"), "h1", "h2", form.alias("form"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, form string, prefix_units bigint, middle_units bigint, output binary"
    target = arrow_schema(schema)
    p, s, m = (x.encode() for x in markers)

    def cut(batches):
        begin()
        for batch in batches:
            for part in slices(batch, "text"):
                drawn = [part.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")]
                n, cuts, at, blob = unit_cuts(part.column("text"), unit, drawn)
                cuts, at = np.sort(cuts, axis=0), np.sort(at, axis=0)
                forms, output = part.column("form").to_pylist(), []
                for kind, (a, b, c, d) in zip(forms, at.T.tolist()):
                    if kind == "psm":
                        output.append(b"".join((p, blob[a:b], s, blob[c:d], m, blob[b:c])))
                    elif kind == "spm":
                        output.append(b"".join((s, blob[c:d], p, blob[a:b], m, blob[b:c])))
                    else:
                        output.append(blob[a:d])
                whole = np.array([x == "plain" for x in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(target.field("doc_id").type),
                        pa.array(n, pa.int64()),
                        part.column("form").cast(pa.string()),
                        pa.array(cuts[0], pa.int64(), mask=whole),
                        pa.array(cuts[1] - cuts[0], pa.int64(), mask=whole),
                        pa.array(output, pa.binary()),
                    ],
                    schema=target,
                )
        give_back()

    return src.mapInArrow(cut, schema).withColumn("output", F.col("output").cast("string"))


def restore(transformed: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Add ``restored``, the text that columns form and output were made of.
    A transformed text holds no marker of its own, so each marker stands
    once. Null output or form: null."""
    parts = F.split("output", "|".join(re.escape(x) for x in markers))
    piece = lambda i: F.get(parts, F.lit(i))
    psm, spm = F.concat(piece(1), piece(3), piece(2)), F.concat(piece(2), piece(3), piece(1))
    text = F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm)
    return transformed.withColumn("restored", text)
