"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

The symbols of a piece form a linked list; a heap holds the adjacent pairs that have a merge. The pair
of the lowest rank is popped again and again, its two symbols become one, and the pairs beside it are
pushed. The count is the initial symbols minus the merges made.

Results: null text is empty and counts 0. Special strings of the vocabulary inside a text count as one
token each, as the tokenizer's library takes them by default. Texts of any length are counted whole;
repeated rows get equal results. Input columns named like the outputs are replaced.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .bpe import ship
from .shared import BoundedCache

_IN_PROCESS: dict[tuple, object] = {}
LOW = (1 << 32) - 1


def merged_count(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left when every merge is made, lowest rank first and leftmost among equals.

    merges: (left << 32 | right) -> (rank, merged symbol)
    """
    n = len(symbols)
    after, before, symbol = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    heap = []
    for i in range(n - 1):
        if found := merges.get(symbol[i] << 32 | symbol[i + 1]):
            heap.append(found[0] << 32 | i)
    heapify(heap)
    made = 0
    while heap:
        top = heappop(heap)
        i = top & LOW
        j = after[i]
        if symbol[i] < 0 or j >= n:
            continue
        found = merges.get(symbol[i] << 32 | symbol[j])
        if not found or found[0] != top >> 32:
            continue  # the pair has changed since it was pushed
        made += 1
        symbol[i], symbol[j] = found[1], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if right := merges.get(symbol[i] << 32 | symbol[k]):
                heappush(heap, right[0] << 32 | i)
        if (h := before[i]) >= 0 and (left := merges.get(symbol[h] << 32 | symbol[i])):
            heappush(heap, left[0] << 32 | h)
    return n - made


class Counter:
    """Counts for one byte-level vocabulary file (the JSON form with merges and added tokens)."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        spec = json.loads(raw)
        vocab = spec["model"]["vocab"]
        chars = byte_characters()
        self.of_byte = [vocab[chars[b]] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left] << 32 | vocab[right]] = (rank, vocab[left + right])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(pattern).findall
        self.cache = BoundedCache(lambda t: merged_count([self.of_byte[b] for b in t.encode()], self.merges), bound=300_000)

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.cache.__getitem__, self.pieces(p))) for p in parts)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes follow from U+0100 on in order.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def counter(shipped: Broadcast, pattern: str) -> Counter:
    key = (len(shipped.value), hash(shipped.value), pattern)
    if key not in _IN_PROCESS:
        _IN_PROCESS[key] = Counter(shipped.value, pattern)
    return _IN_PROCESS[key]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 1024, text_col: str = "text") -> DataFrame:
    """The documents with n_bytes, n_tokens and over_limit of their whole texts."""
    shipped = ship(docs.sparkSession, vocabulary)

    @F.arrow_udf(LongType())
    def tokens(texts: pa.Array) -> pa.Array:
        count = counter(shipped, pattern).count
        return pa.array((count(t or "") for t in texts.to_pylist()), pa.int64())

    text = F.col(text_col)
    sized = docs.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "n_tokens": tokens(text)})
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
