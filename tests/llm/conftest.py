"""A small documents table with every awkward case, and folders that queries can read."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, id string"

ODD = [None, "", "   \n\t ", "a", "?!", "12345", "\x00\x1c\x85 x", "é😀日本 ª", "<|endoftext|> x<|endoftext|>", "a" * 3000, "a b c d e f g h " * 400]


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars): copies, near copies, odd texts, null and repeated ids."""
    rng = random.Random(5)
    texts = list(ODD)
    letters = {"aa": "abcdefgh", "bb": "mnopqrst"}
    langs = [None] * len(texts)
    for lang, own in letters.items():
        for _ in range(24):
            texts.append("\n".join(words(rng, rng.randint(4, 30), own) for _ in range(rng.randint(1, 5))))
            langs.append(lang)
    for i in range(4):  # exact and near copies
        texts += [texts[20 + i], texts[20 + i] + " zz"]
        langs += [langs[20 + i], None]
    passage = words(rng, 60)
    for _ in range(5):
        texts.append(f"{words(rng, 20)} {passage} {words(rng, 20)}")
        langs.append("aa")
    out = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(zip(texts, langs))]
    out.append((3, out[30][1], None, None, None))  # a repeated id
    out.append(out[25])  # a repeated row
    out.append((None, out[40][1], None, None, None))
    return out


@pytest.fixture(scope="session")
def table(spark, rows):
    """The rows, with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder(spark, table, tmp_path_factory):
    """A data folder with this documents table and a small benchmark."""
    top = str(tmp_path_factory.mktemp("sf"))
    table.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{top}/documents.parquet")
    items = [(0, "this benchmark sentence is long enough to be found anywhere"), (1, None), (2, ""), (3, "short")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


@pytest.fixture(scope="session")
def empty_folder(spark, empty, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("none"))
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top
