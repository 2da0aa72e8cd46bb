"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary.

The vocabulary is a rank file (a line: base64 of the token's bytes, a space, the rank). Every byte is
mapped to one character, every token to the piece of its bytes' characters with the negative rank as
its score, and the normalisation is the identity. Merging the best-scored adjacent pair is then
merging the lowest rank, and piece ids are ranks. Each match of the splitting pattern is encoded
separately; decoding maps ids back to the bytes of their tokens.

Results: null text is empty; an empty text has no ids and decodes to no bytes. Texts of any length
are encoded whole. Repeated rows get equal results. An input column named like the output is replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

#: The character of byte b is chr(FIRST + b): letters without a meaning to the model.
FIRST = 0x100
UNKNOWN = "<unk>"
#: Pieces whose ids a task remembers, and texts that it splits at a time; neither changes a result.
CACHED, AT_ONCE = 60_000, 64

_IN_PROCESS: dict[tuple, object] = {}


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and rank of every line of a rank file."""
    pairs = (line.split() for line in raw.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def as_piece(data: bytes) -> str:
    return "".join(chr(FIRST + b) for b in data)


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: an integer, a 32-bit float, or bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + array("f", [value]).tobytes()
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: pieces in the order of their ranks, then the unknown piece."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without a gap")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks single bytes, such as {missing[0]}")
    # Fixed values, field numbers and enumerations of the public model format.
    piece, score, kind, normal, unknown = 1, 2, 3, 1, 2
    pieces, trainer, normaliser = 1, 2, 3
    model_type, bpe, unk_id, bos_id, eos_id, pad_id = 3, 2, 40, 41, 42, 43
    name, dummy_prefix, drop_spaces, escape_spaces = 1, 3, 4, 5
    out = [
        _field(pieces, _field(piece, as_piece(t).encode()) + _field(score, float(-r)) + _field(kind, normal))
        for r, t in enumerate(by_rank)
    ]
    out.append(_field(pieces, _field(piece, UNKNOWN.encode()) + _field(score, 0.0) + _field(kind, unknown)))
    ids = ((unk_id, len(by_rank)), (bos_id, -1), (eos_id, -1), (pad_id, -1))
    out.append(_field(trainer, _field(model_type, bpe) + b"".join(_field(k, v) for k, v in ids)))
    flags = b"".join(_field(k, 0) for k in (dummy_prefix, drop_spaces, escape_spaces))
    out.append(_field(normaliser, _field(name, b"identity") + flags))
    return b"".join(out)


class Codec:
    """Encoder and decoder of one vocabulary, made once in each Python process."""

    def __init__(self, raw: bytes, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(raw)
        self.pieces = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.bytes_of = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.to_char = {b: FIRST + b for b in range(256)}
        # A token that its own merges do not rebuild is still taken whole where a match equals it.
        tokens = list(ranks)
        got = self.model.encode([as_piece(t) for t in tokens], out_type=int, num_threads=1)
        self.whole = {t: ranks[t] for t, ids in zip(tokens, got, strict=True) if len(ids) != 1}
        self.cache: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that the cache lacks, in one call of the model."""
        data = [p.encode() for p in pieces]
        mapped = [d.decode("latin-1").translate(self.to_char) for d in data]
        for p, d, ids in zip(pieces, data, self.model.encode(mapped, out_type=int, num_threads=1), strict=True):
            whole = self.whole.get(d)
            self.cache[p] = array("i", ids if whole is None else [whole]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers in native order."""
        split = [self.pieces(t) for t in texts]
        known = self.cache
        if len(known) > CACHED:
            known.clear()
        if unknown := set().union(*split).difference(known):
            self._learn(list(unknown))
        return [b"".join(map(known.__getitem__, p)) for p in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(shipped: Broadcast, pattern: str) -> Codec:
    key = (len(shipped.value), hash(shipped.value), pattern)
    if key not in _IN_PROCESS:
        _IN_PROCESS[key] = Codec(shipped.value, pattern)
    return _IN_PROCESS[key]


def ship(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's bytes; a vocabulary is bounded, whatever the corpus."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoded(text: Column, shipped: Broadcast, pattern: str) -> Column:
    """Token ids of a text column."""

    @F.arrow_udf(ArrayType(IntegerType(), False))
    def ids(texts: pa.Array) -> pa.Array:
        encode, made = codec(shipped, pattern).encode, []
        for start in range(0, len(texts), AT_ONCE):
            made += encode([t or "" for t in texts.slice(start, AT_ONCE).to_pylist()])
        offsets = np.zeros(len(made) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in made], out=offsets[1:])
        flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(made))])
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return ids(text)


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    return batch.append_column(name, values) if at < 0 else batch.set_column(at, name, values)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """The documents with the ids of their whole texts in column `out`."""
    return docs.withColumn(out, encoded(F.col(text_col), ship(docs.sparkSession, vocabulary), pattern))


def decode_documents(docs: DataFrame, vocabulary: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The documents with the bytes of their ids in column `out`; null ids decode to no bytes.

    A step of its own (not a column function), so that the ids it reads are not made twice.
    """
    shipped = ship(docs.sparkSession, vocabulary)
    schema = StructType([f for f in docs.schema if f.name != out] + [StructField(out, BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(shipped, pattern).decode
        for batch in batches:
            lists = batch.column(ids_col)
            data = (decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in lists)
            yield _replaced(batch, out, pa.array(data, pa.binary())).select(schema.names)

    return docs.mapInArrow(decoded, schema)
