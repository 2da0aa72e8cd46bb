"""Line dedup by a deletion-neighbourhood join over words.

Lines are compared as their lower-cased words. Of every line the earliest occurrence stays (by document
id, then line number); later equal lines go, and so does a line of at least `near` words or LONG
characters that is within one edit (a symbol put in, left out or replaced) of an earlier such line. Symbols
are words, or characters in lines of fewer than FEW_WORDS words, as in scripts without spaces.

Equal lines are grouped by a 128-bit hash. For the rest, a pair within one edit shares the words before
or after the middle, so lines that share neither half with another line are done. The remaining ones
emit all variants with one word of the half in question deleted, as hashed keys: lines with equal
variants (and the variant of one that equals another as it is) meet in a join on the key, where each is
linked to the group's earliest. The word edit distance of every such link is then verified. Groups are
only ever reduced to their earliest member, never gathered or paired out.

Results: null text has no lines; lines of fewer than `least` words (those without any) are left alone. Documents keep their
row; apply() drops those that had lines and lost them all. Documents with equal id and text are one
document and are treated alike; null ids come last. Other columns are untouched; apply() replaces only
the text. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .rolling import INVERSE, mixed, powers, prefix_sums, word_hashes
from .shared import held, prefiltered

#: Fewest words of a line that is compared at all, and of one that an edited line can match.
LEAST, NEAR = 1, 8
#: Characters from which lines of fewer words can match edited ones too; words below which characters are compared.
LONG, FEW_WORDS = 20, 4


def _halves(n: np.ndarray | int):
    """For the two lengths m the shorter of a pair can have: words before its middle, words after."""
    return [(m, m // 2, m - m // 2) for m in (n - 1, n)]


def text_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_words(line: str) -> list[str]:
    return line.lower().split()


def line_symbols(words: list[str]) -> list[str]:
    """What edits are counted in: words, or characters, marked as such."""
    return words if len(words) >= FEW_WORDS else ["\0" + c for c in " ".join(words)]


def marks_of(text: str | None, least: int, near: int) -> tuple:
    """Columns (line, words, two hashes of the line, two packed pairs of half keys) of a text's lines."""
    from xxhash import xxh3_128_intdigest

    split = [(i, w) for i, x in enumerate(text_lines(text)) if len(w := line_words(x)) >= least]
    at, n = np.array([i for i, _ in split], np.int32), np.array([len(w) for _, w in split], np.int64)
    whole_lines = [" ".join(w) for _, w in split]
    digest = b"".join(xxh3_128_intdigest(x).to_bytes(16, "little") for x in whole_lines)
    whole = np.frombuffer(digest, np.int64).reshape(-1, 2)
    keys = np.zeros((len(split), 4), np.uint64)
    open_to = np.flatnonzero((n >= near) | (np.array(list(map(len, whole_lines)), np.int64) >= LONG))
    if len(open_to):
        symbols = [line_symbols(split[i][1]) for i in open_to.tolist()]
        sums = prefix_sums(word_hashes([x for s in symbols for x in s]))
        _, inverse = powers(len(sums))
        size = np.array(list(map(len, symbols)), np.int64)
        ends = np.cumsum(size)
        starts = ends - size
        made = np.zeros((len(size), 4), np.uint64)
        for k, (m, before, after) in enumerate(_halves(size)):
            made[:, 2 * k] = mixed((sums[starts + before] - sums[starts]) * inverse[starts], 2 * m)
            made[:, 2 * k + 1] = mixed((sums[ends] - sums[ends - after]) * inverse[ends - after], 2 * m + 1)
        keys[open_to] = made >> np.uint64(33) | np.uint64(1 << 31)
    packed = (keys[:, 0::2] << np.uint64(32) | keys[:, 1::2]).astype(np.int64)
    return at, n.astype(np.int32), whole[:, 0], whole[:, 1], packed[:, 0], packed[:, 1]


MARKS = ArrayType(StructType([StructField(c, IntegerType()) for c in ("line", "n")] + [StructField(c, LongType()) for c in ("h1", "h2", "k1", "k2")]))


def _lists(parts: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Array:
    """One list of structs for each tuple of equally long columns."""
    offsets = np.concatenate(([0], np.cumsum([len(p[0]) for p in parts]))).astype(np.int32)
    flat = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], t) for i, t in enumerate(types)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(flat, names))


def _marks(text: Column, least: int, near: int) -> Column:
    @F.arrow_udf(MARKS)
    def marks(texts: pa.Array) -> pa.Array:
        return _lists([marks_of(t, least, near) for t in texts.to_pylist()], ["line", "n", "h1", "h2", "k1", "k2"], [pa.int32(), pa.int32()] + [pa.int64()] * 4)

    return marks(text)


def variants_of(words: np.ndarray, before: bool, after: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a line's variants, and for each whether it is the line itself.

    Deleting the word at p gives a key with p (lines that differ in that word share it) and a key
    without (it equals the own key of a line that lacks the word).
    """
    n = len(words)
    power, inverse = powers(n + 1)
    sums = prefix_sums(words)
    middle = (n - 1) // 2
    p = np.arange(0 if before else middle, n if after else middle + 1)
    left = sums[p] + (sums[n] - sums[p + 1]) * np.uint64(INVERSE)
    same = mixed(mixed(left, n), p + 2)
    shorter = mixed(left, n - 1)
    own = mixed(sums[n:], n)
    keys = np.concatenate((same, shorter, own)).astype(np.int64)
    itself = np.zeros(len(keys), bool)
    itself[-1] = True
    return keys, itself


VARIANTS = ArrayType(StructType([StructField("key", LongType()), StructField("itself", BooleanType())]))


@F.arrow_udf(VARIANTS)
def variants(words: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
    parts = [
        variants_of(w.values.to_numpy().view(np.uint64), b, a)
        for w, b, a in zip(words, before.to_pylist(), after.to_pylist(), strict=True)
    ]
    return _lists(parts, ["key", "itself"], [pa.int64(), pa.bool_()])


@F.arrow_udf(ArrayType(ArrayType(LongType())))
def words_at(texts: pa.Array, lines: pa.Array) -> pa.Array:
    """Symbol hashes of the given lines of each text."""
    out = []
    for text, at in zip(texts.to_pylist(), lines.to_pylist(), strict=True):
        split = text_lines(text)
        out.append([word_hashes(line_symbols(line_words(split[i]))).view(np.int64) for i in at])
    return pa.array(out, pa.list_(pa.list_(pa.int64())))


def within_one_edit(a: list, b: list) -> bool:
    """Whether at most one item put in, left out or replaced turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


@F.arrow_udf(BooleanType())
def verified(one: pa.Array, other: pa.Array) -> pa.Array:
    return pa.array(map(within_one_edit, one.to_pylist(), other.to_pylist()), pa.bool_())


def _occurrence() -> Column:
    """The order in which lines come: documents by id (null last), then line numbers."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "line")


def _near_lines(lines: DataFrame) -> DataFrame:
    """Rows (h1, h2, first, before, after): lines with a half in common with another line."""
    halves = [F.struct(F.shiftright(c, 32 * (1 - side)).bitwiseAND(F.lit(0xFFFFFFFF)).alias("key"), F.lit(bool(side)).alias("before")) for c in ("k1", "k2") for side in (0, 1)]
    dealt = lines.where(F.col("k1") != 0).select("h1", F.explode(F.array(*halves)).alias("half")).select("h1", "half.*")
    # Occurrences of one line have one h1, so they need not be reduced first.
    shared = dealt.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("key")
    hit = held(dealt.join(shared, "key").groupBy("h1").agg(F.bool_or("before").alias("before"), F.bool_or(~F.col("before")).alias("after")))
    return lines.join(hit, "h1").groupBy("h1", "h2").agg(F.min(_occurrence()).alias("first"), F.first("before").alias("before"), F.first("after").alias("after"))


def _edited(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (h1, h2) of the lines within one edit of an earlier line."""
    close = _near_lines(lines)
    wanted = held(close.groupBy("first.id", "first.text_hash").agg(F.collect_list(F.struct("first.line", "h1", "h2", "before", "after")).alias("lines")))
    texts = prefiltered(docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")), wanted)
    met = texts.join(wanted, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")))
    read = met.select("id", "text_hash", F.explode(F.arrays_zip("lines", words_at("text", F.col("lines.line")).alias("words"))).alias("x"))
    rows = read.select("id", "text_hash", "x.lines.*", "x.words").dropDuplicates(["h1", "h2"])
    in_order = rows.orderBy(F.col("id").isNull(), "id", "text_hash", "line")
    lines = held(in_order.select(F.monotonically_increasing_id().alias("no"), "h1", "h2", "words", "before", "after"))
    emitted = lines.select("no", F.explode(variants("words", "before", "after")).alias("v")).select("no", "v.*")
    least = {"any": F.min("no"), "own": F.min(F.when(F.col("itself"), F.col("no"))), "made": F.min(F.when(~F.col("itself"), F.col("no")))}
    groups = emitted.groupBy("key").agg(F.count("*").alias("times"), *(c.alias(k) for k, c in least.items())).where("times > 1")
    # Keys with a position hold only lines that differ there; a key that a line has as it is links
    # that line with the variants, but not the variants with each other.
    earlier = F.when(F.col("itself"), F.col("made")).otherwise(F.coalesce("own", "any"))
    links = emitted.join(groups, "key").select("no", earlier.alias("keeper")).where("keeper < no").distinct()
    one, other = lines.alias("one"), lines.select("no", "words").alias("other")
    pairs = links.join(one, "no").join(other, F.col("keeper") == F.col("other.no"))
    return pairs.where(verified("one.words", "other.words")).select("one.h1", "one.h2").distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, near: int = NEAR) -> DataFrame:
    """Rows (id, text_hash, lines): the numbers of the lines that go, for documents that lose any."""
    found = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.explode(_marks(F.col(text_col), least, near)).alias("m"))
    lines = held(found.select("id", "text_hash", "m.*"))
    edited = held(_edited(docs, lines, id_col, text_col)).withColumn("near", F.lit(True))
    by_line = lines.groupBy("h1", "h2").agg(F.min(_occurrence()).alias("first"), F.count("*").alias("times"))
    # Only lines that recur or are edited can go. Written first, so that the join that brings their
    # occurrences together can split a line that holds a large share of them.
    judged = held(by_line.join(edited, ["h1", "h2"], "left").where("times > 1 or near").select("h1", "h2", "first", "near"))
    going = lines.join(judged, ["h1", "h2"]).where(F.col("near") | (F.col("first") != _occurrence()))
    return going.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("lines"))


@F.arrow_udf(StringType())
def _without(texts: pa.Array, lines: pa.Array) -> pa.Array:
    out = []
    for text, gone in zip(texts.to_pylist(), lines.to_pylist(), strict=True):
        if text is not None and gone:
            drop = set(gone)
            text = "\n".join(x for i, x in enumerate(text_lines(text)) if i not in drop)
        out.append(text)
    return pa.array(out, pa.string())


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, near: int = NEAR) -> DataFrame:
    """The documents without the repeated lines; those of which no word is left go."""
    columns = docs.columns
    gone = removed_lines(docs, id_col, text_col, least, near)
    rows = docs.select(F.struct(*columns).alias("row"), F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    met = rows.join(gone, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    kept = met.select("row", "lines", _without("text", "lines").alias("text"))
    stays = F.col("lines").isNull() | F.col("text").rlike(r"\S")
    return kept.where(stays).select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns))
