"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be changed by k = floor(share * m) edits. It is split into k + 1
pieces; a passage within k edits holds one piece unchanged. One automaton finds all pieces in a text,
each hit opens a window where the item would lie, and Myers' bit-parallel distance over the window
decides. Texts and items are compared lower-cased, with runs of white space as one space.

The items are cut into blocks of bounded size, and each block's automaton (whose size is thus bounded)
is shipped to the tasks: a stated query set against all rows, without a join. Results: null texts and
null, empty or very short items (below `least` characters) match nothing; repeated items and rows
each get their own result; an empty benchmark leaves all documents clean. Input columns named like the
outputs are replaced.
"""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

#: Share of an item's characters that may be edited, shortest item, characters of a block of items.
SHARE, LEAST, BLOCK_CHARS = 0.06, 20, 1_000_000

MATCH = ArrayType(StructType([StructField("item_id", LongType()), StructField("edits", IntegerType())]), False)

_IN_PROCESS: dict[str, object] = {}


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their offsets."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(item):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def least_edits(masks: dict[str, int], m: int, text: str) -> int:
    """Myers' distance of a pattern of m characters to the part of the text that is nearest to it."""
    full, high = (1 << m) - 1, 1 << m - 1
    plus, minus, score, best = full, 0, m, m
    for ch in text:
        equal = masks.get(ch, 0)
        vertical = equal | minus
        horizontal = ((equal & plus) + plus ^ plus) | equal
        up, down = minus | ~(horizontal | plus) & full, plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
    return best


class Finder:
    """Automaton and masks of one block of (item_id, normalised item) rows."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        import ahocorasick

        self.items = [(i, len(t), int(share * len(t)), masks_of(t)) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.items[at][2]):
                places.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item_id, edits) of every item that the text holds, in the order of the items."""
        if self.empty or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (length, found) in self.automaton.iter(text):
            for at, offset in found:
                _, m, k, _ = self.items[at]
                start = end + 1 - length - offset
                a, b = max(0, start - k), start + m + k
                if (own := windows.setdefault(at, [])) and a <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        out = []
        for at in sorted(windows):
            item, m, k, masks = self.items[at]
            if (edits := min(least_edits(masks, m, text[a:b]) for a, b in windows[at])) <= k:
                out.append((item, edits))
        return out


def _finder(name: str, shipped: Broadcast, share: float) -> Finder:
    if name not in _IN_PROCESS:
        _IN_PROCESS.clear()  # one block's automaton at a time
        _IN_PROCESS[name] = Finder(pickle.loads(shipped.value), share)
    return _IN_PROCESS[name]


def _matches(text: Column, items: list[tuple[int, str]], share: float, docs: DataFrame) -> Column:
    data = pickle.dumps(items)
    shipped, name = docs.sparkSession.sparkContext.broadcast(data), f"{share}:{hash(data)}:{len(data)}"

    @F.arrow_udf(MATCH)
    def found(texts: pa.Array) -> pa.Array:
        find = _finder(name, shipped, share).find
        rows = [[{"item_id": i, "edits": e} for i, e in find(normal(t))] for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32())])))

    return found(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, least: int = LEAST, block_chars: int = BLOCK_CHARS, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with `matches`: item ids and edits of the benchmark items that they hold."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    none = F.array().cast(MATCH)
    found = none
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select("item", "text").collect()
        block = sorted(((r.item, t) for r in rows if len(t := normal(r.text)) >= least), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if block:
            found = F.concat(found, _matches(F.col(text_col), block, share, docs))
    return docs.withColumn("matches", found)


def clean_only(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that hold no benchmark item; an own column named `matches` is kept."""
    text_col = settings.pop("text_col", "text")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    return contaminated(whole, benchmark, text_col="text", **settings).where(F.size("matches") == 0).select("row.*")
