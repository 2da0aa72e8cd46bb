"""Fill-in-middle transformation: content-defined chunks with memoized boundary summaries.

A text is cut into units (a word with the space before it, or the space at the text's end). Where its
two cuts lie is asked of chunks, not of the text: a rolling hash over sixteen bytes ends a chunk wherever
its low bits are zero, so that copies of a passage fall into equal chunks wherever they stand. Each chunk
has a summary that does not depend on its neighbours: its characters, whether it begins and ends inside a
word, and the places at which words end inside it. Summaries are kept by the chunk's whole content (the
look-up compares it), so a chunk that many documents share is read once in a task. Sums of the chunks' counts,
with one more where a word ends at a boundary, tell the number of units and the chunk in which a cut lies;
its own places give the rest.

The order of the parts is drawn from the document's id alone: ``42:`` and the id, hashed, give four
numbers for the two cuts, for whether the text is changed and for which of the two forms it takes.

Results: a null text is an empty one and stays plain, as does a text that holds a marker itself. A null
id draws as an empty one. Equal ids draw alike, repeated rows get equal results, extra columns are kept by
``transform``, but for ``fim``, which it sets. Texts are whole, of any length; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import BoundedCache

# Fixed values of the transformation.
SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM_RATE = 50, 80  # of a hundred: texts that are changed, and changed ones with the suffix first

#: Bytes that the rolling hash sees, and of a chunk: at least, at most, and on average 256 more than the least.
WINDOW, SHORTEST, LONGEST, MASK = 16, 64, 2048, 0xFF
#: Chunks whose summaries a task keeps at a time.
KEPT_CHUNKS = 20_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STIRRED = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
_BASE = 0x01000193


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that end at each place from WINDOW - 1 on; by doubling widths."""
    h, width, power = _STIRRED[data], 1, _BASE
    while width < WINDOW:
        h = h[:-width] * np.uint32(power) + h[width:]
        width, power = 2 * width, power * power & 0xFFFFFFFF
    return h ^ h >> np.uint32(15)


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks end: at the content's own places, no closer than SHORTEST, no further than LONGEST."""
    n, out, at = len(data), [], 0
    if n > SHORTEST:
        marks = np.flatnonzero(rolling(data) & np.uint32(MASK) == 0) + WINDOW
        while n - at > SHORTEST:
            i = int(np.searchsorted(marks, at + SHORTEST))
            at = min(int(marks[i]) if i < len(marks) else n, at + LONGEST, n)
            out.append(at)
    if at < n:
        out.append(n)
    return out


class Summary:
    """What a chunk tells its neighbours: characters, word bytes at its two ends, and where words end in it."""

    __slots__ = ("chars", "opens", "closes", "ends")

    def __init__(self, chunk: bytes):
        data = np.frombuffer(chunk, np.uint8)
        word = ~_SPACE[data]
        self.chars = int(np.count_nonzero(data & 0xC0 != 0x80))
        self.opens, self.closes = bool(word[0]), bool(word[-1])
        self.ends = (np.flatnonzero(word[:-1] & ~word[1:]) + 1).astype(np.uint16)


_CACHE: list[BoundedCache] = []


def _summaries() -> BoundedCache:
    if not _CACHE:
        _CACHE.append(BoundedCache(Summary, KEPT_CHUNKS, LONGEST))
    return _CACHE[0]


class Units:
    """The units of one text, counted and found by its chunks."""

    def __init__(self, text: bytes):
        self.text, known = text, _summaries()
        self.stops = chunk_ends(np.frombuffer(text, np.uint8))
        self.starts = [0, *self.stops[:-1]]
        self.parts = [known[text[a:b]] for a, b in zip(self.starts, self.stops)]
        # A word that ends where its chunk does is counted with that chunk.
        nexts = [p.opens for p in self.parts[1:]] + [False]
        self.at_border = [p.closes and not after for p, after in zip(self.parts, nexts)]
        self.upto = np.cumsum([len(p.ends) + b for p, b in zip(self.parts, self.at_border)])
        words = int(self.upto[-1]) if self.parts else 0
        self.count = words + (bool(self.parts) and not self.parts[-1].closes)

    def end_of(self, units: int) -> int:
        """The byte at which the first so many units end."""
        if units == 0:
            return 0
        if units > (int(self.upto[-1]) if self.parts else 0):
            return len(self.text)
        k = int(np.searchsorted(self.upto, units))
        nth = units - (int(self.upto[k - 1]) if k else 0) - 1
        ends = self.parts[k].ends
        return self.starts[k] + int(ends[nth]) if nth < len(ends) else self.stops[k]

    def chars_before(self, byte: int) -> int:
        """Characters before a byte: those of whole chunks, and of the part of the last one."""
        k = int(np.searchsorted(self.stops, byte, "right"))
        rest = np.frombuffer(self.text, np.uint8)[self.starts[k] : byte] if k < len(self.parts) else np.zeros(0, np.uint8)
        return sum(p.chars for p in self.parts[:k]) + int(np.count_nonzero(rest & 0xC0 != 0x80))


CUTS = StructType([StructField(c, LongType()) for c in ("n", "first", "second")])


@F.arrow_udf(CUTS)
def cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Units of each text, and the characters before its two cuts; a null draw asks for the number only."""
    out: list[list[int | None]] = [[], [], []]
    for text, a, b in zip(texts.cast(pa.binary()), one.to_pylist(), two.to_pylist(), strict=True):
        units = Units(text.as_py() or b"")
        drawn = [None, None] if a is None else [units.chars_before(units.end_of(x)) for x in sorted((a % (units.count + 1), b % (units.count + 1)))]
        for column, value in zip(out, [units.count, *drawn]):
            column.append(value)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in out], CUTS.names)


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 that depend on the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The rows with ``fim``: n, form, prefix_chars, middle_chars (null if plain) and output."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    one, two, three, four = draws(F.col(id_col), seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (three % 100 >= rate)
    form = F.when(plain, "plain").when(four % 100 < spm_rate, "spm").otherwise("psm")
    found = docs.withColumn("fim", F.struct(form.alias("form"), cuts(text, F.when(~plain, one), F.when(~plain, two)).alias("at")))
    form, at = F.col("fim.form"), F.col("fim.at")
    head = F.substring(text, F.lit(1), at["first"].cast("int"))
    mid = F.substring(text, (at["first"] + 1).cast("int"), (at["second"] - at["first"]).cast("int"))
    tail = F.substring(text, (at["second"] + 1).cast("int"), F.length(text))
    psm = F.concat(F.lit(PREFIX), head, F.lit(SUFFIX), tail, F.lit(MIDDLE), mid)
    spm = F.concat(F.lit(SUFFIX), tail, F.lit(PREFIX), head, F.lit(MIDDLE), mid)
    output = F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)
    return found.withColumn(
        "fim",
        F.struct(at["n"].alias("n"), form.alias("form"), at["first"].alias("prefix_chars"), (at["second"] - at["first"]).alias("middle_chars"), output.alias("output")),
    )


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from an output and its form alone; no part can hold a marker."""
    def after(marker: str) -> Column:
        return F.substring_index(output, marker, -1)

    def before(part: Column, marker: str) -> Column:
        return F.substring_index(part, marker, 1)

    psm = F.concat(before(after(PREFIX), SUFFIX), after(MIDDLE), before(after(SUFFIX), MIDDLE))
    spm = F.concat(before(after(PREFIX), MIDDLE), after(MIDDLE), before(after(SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
