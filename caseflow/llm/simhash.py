"""SimHash near-duplicates through pivot distance tables.

A text's fingerprint has a bit set where more than half of its three-word shingles' 64-bit hashes
have it. Copies share a fingerprint, so the search runs over distinct fingerprints. Each has a table of
its Hamming distances to sixteen reference fingerprints, kept block by block for six blocks of bits:
two fingerprints that differ in at most three bits leave three blocks untouched, so their distances in
those blocks are equal. Pairs that agree in the table's coordinates of some three blocks are joined,
pairs with a coordinate (the distance to a reference, all blocks) further apart than the radius are
discarded, and the rest are verified bit by bit. Joins on equal coordinates lose no pair and never
compare all with all.

Results: null and wordless texts have fingerprint 0 and are linked like any other. Repeated rows and
ids share a component. The component is named by its smallest id; ids that are null are passed over,
and it is null where there is no other. An empty table gives no rows. Input columns named like the
outputs are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .components import components
from .shared import doc_key, held

BITS, BLOCKS, UNTOUCHED, REFERENCES = 64, 6, 3, 16
RADIUS = BLOCKS - UNTOUCHED
SHINGLE, SEED = 3, 42
#: Shingles whose bits are counted at a time; it bounds the memory of a very long text.
AT_ONCE = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def reference_fingerprints(n: int = REFERENCES) -> list[int]:
    """Fixed pseudo-random fingerprints: consecutive odd multiples of a constant, mixed."""
    out, mask = [], (1 << 64) - 1
    for i in range(1, n + 1):
        x = i * 0x9E3779B97F4A7C15 & mask
        for shift in (30, 27, 31):
            x = (x ^ x >> shift) * 0xBF58476D1CE4E5B9 & mask
        out.append(_signed(x))
    return out


def block_masks() -> list[int]:
    of_bit = [bit * BLOCKS // BITS for bit in range(BITS)]
    return [_signed(sum(1 << bit for bit in range(BITS) if of_bit[bit] == b)) for b in range(BLOCKS)]


def fingerprint_of(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII space separates
    if not words:
        return 0
    step = min(SHINGLE, len(words))
    counts, n = np.zeros(BITS, np.int64), len(words) - step + 1
    for start in range(0, n, AT_ONCE):
        part = words[start : start + AT_ONCE + step - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(step))))
        digests = b"".join([xxh64_digest(s, SEED) for s in shingles])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, BITS // 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array((_signed(fingerprint_of(t)) for t in texts.to_pylist()), pa.int64())


def _table(fp: Column, masks: list[int], refs: list[int]) -> list[Column]:
    """For each block the distances to all references inside it, packed four bits each."""
    def packed(mask: int) -> Column:
        parts = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("long"), 4 * j) for j, p in enumerate(refs)]
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out
    return [packed(m) for m in masks]


def linked_fingerprints(distinct: DataFrame, fp_col: str = "fp") -> DataFrame:
    """Pairs (one < other) of distinct fingerprints within the radius."""
    refs, masks = reference_fingerprints(), block_masks()
    fp = F.col(fp_col)
    blocks = distinct.select(fp.alias("fp"), *(c.alias(f"b{i}") for i, c in enumerate(_table(fp, masks, refs))))
    keys = [F.xxhash64(F.lit(i), *(F.col(f"b{b}") for b in kept)) for i, kept in enumerate(combinations(range(BLOCKS), UNTOUCHED))]
    dealt = blocks.select("fp", F.explode(F.array(*keys)).alias("key"))
    one, other = dealt.alias("one"), dealt.alias("other")
    a, b = F.col("one.fp"), F.col("other.fp")
    apart = [F.abs(F.bit_count(a.bitwiseXOR(F.lit(p))) - F.bit_count(b.bitwiseXOR(F.lit(p)))) for p in refs]
    near = (F.greatest(*apart) <= RADIUS) & (F.bit_count(a.bitwiseXOR(b)) <= RADIUS)
    met = one.join(other, (F.col("one.key") == F.col("other.key")) & (a < b))
    return met.where(near).select(a.alias("one"), b.alias("other")).distinct()


def _classes(marks: DataFrame, id_col: str) -> DataFrame:
    """Rows (fp, component_id) for every distinct fingerprint in marks(id_col, fp)."""
    distinct = held(marks.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = held(components(linked_fingerprints(distinct), "one", "other"))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return held(rooted.join(named, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, fingerprint (long, two's complement) and component_id."""
    marks = held(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")))
    named = marks.join(_classes(marks, "id"), "fp")
    return named.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one of each component: the row of the smallest id, then of the smallest text hash."""
    key, columns = doc_key(id_col, text_col), docs.columns
    marks = held(docs.select(F.col(id_col).alias("id"), key.alias("key"), fingerprint(F.col(text_col)).alias("fp")))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    grouped = marks.join(_classes(marks, "id"), "fp")
    # A component without any id is told apart by its smallest fingerprint, the rest by their name.
    name = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    stay = grouped.groupBy(name.alias("name")).agg(F.min_by("key", order).alias("key")).select("key")
    whole = docs.select(F.struct(*columns).alias("row"), key.alias("key")).join(stay, "key", "left_semi")
    return whole.dropDuplicates(["key"]).select("row.*")
