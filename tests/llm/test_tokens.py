"""Codec and counts against the tokenizers' own libraries."""

import base64
import hashlib

import pytest
import public_tokenizers as vocabularies
from caseflow.llm import bpe, queries, tokencount

RANKS, JSON = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_codec_query_equals_library(spark, folder, rows, encoding):
    want = []
    for i, t, *_ in rows:
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode())))
    got = [tuple(r) for r in queries.op1_bpe_codec(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_round_trip_keeps_columns(table):
    ids = bpe.encode_documents(table, RANKS, vocabularies.PATTERN)
    back = bpe.decode_documents(ids, RANKS, vocabularies.PATTERN)
    assert back.columns == [*table.columns, "token_ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())


def test_every_token_is_its_own_piece():
    codec = bpe.Codec(open(RANKS, "rb").read(), vocabularies.PATTERN)
    assert codec.whole == {}


def test_vocabulary_must_be_whole():
    with pytest.raises(ValueError, match="gap"):
        bpe.sentencepiece_model({bytes([b]): b + (b > 7) for b in range(256)})
    with pytest.raises(ValueError, match="single bytes"):
        bpe.sentencepiece_model({bytes([b]): b for b in range(255)})


def test_counts_equal_library(spark, folder, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    want = []
    for i, t, *_ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    got = [tuple(r) for r in queries.op9_token_counts(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_heap_merges_lowest_rank_then_leftmost():
    merges = {1 << 32 | 1: (5, 9), 9 << 32 | 9: (1, 10)}
    assert tokencount.merged_count([1, 1, 1, 1, 1], merges) == 2
    assert tokencount.merged_count([], merges) == 0
    assert tokencount.merged_count([2], merges) == 1


def test_empty_tables(spark, empty_folder):
    assert queries.op1_bpe_codec(spark, empty_folder).collect() == []
    assert queries.op9_token_counts(spark, empty_folder).collect() == []
