"""Fill-in-middle: chunks against plain code, forms and digests, exact rebuilding."""

import hashlib
import random
import re

import pytest
from caseflow.llm import fim, queries
from pyspark.sql import functions as F

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = ["a", "bc", " ", "\n", "é", "日", "😀", "x\t", " \x0b\x85", "\xa0", "word ", "<P", ">"]


def plainly(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the rules, without chunks."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed", range(8))
def test_chunks_count_and_locate_like_the_pattern(seed):
    rng = random.Random(seed)
    for size in (0, 1, 2, 60, 63, 64, 65, 300, 2048, 5000):
        for text in ("".join(rng.choice(PIECES) for _ in range(size)), rng.choice(["a", " ", "a ", " ab"]) * size):
            units, found = UNIT.findall(text), fim.Units(text.encode())
            assert found.count == len(units)
            for m in {0, len(units), rng.randint(0, len(units)), len(units) // 2}:
                assert found.chars_before(found.end_of(m)) == len("".join(units[:m]))


def test_chunks_follow_the_content():
    """A passage in other surroundings falls into the same chunks but for those at its ends."""
    rng = random.Random(3)
    passage = "".join(rng.choice(PIECES) for _ in range(6000)).encode()
    def chunks(text):
        ends = fim.chunk_ends(fim.np.frombuffer(text, fim.np.uint8))
        assert all(b - a <= fim.LONGEST for a, b in zip([0, *ends], ends)) and ends[-1] == len(text)
        return [text[a:b] for a, b in zip([0, *ends], ends)]
    alone = chunks(passage)
    inside = set(chunks(b"some words before " * 9 + passage))
    assert len(alone) > 10 and sum(c in inside for c in alone) >= len(alone) - 4


def test_query_equals_plain_code(spark, folder, rows):
    got = queries.op13_fill_in_middle(spark, folder).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        n, form, p, m, output = plainly(doc_id, text)
        want.append((doc_id, n, form, p, m, sha(output), sha(text or "")))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_forms_are_all_taken_and_rebuilt(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 900))) for _ in range(300)] + ["a <P> b c d"] * 20 + [None, "", "日" * 5000, "x " * 90_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fim", F.lit("clash")).withColumn("n", F.lit(1)).repartition(3)
    out = fim.transform(table)
    assert out.columns == ["doc_id", "text", "fim", "n"]
    found = out.select("doc_id", "text", "fim.*", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("again")).collect()
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text)
        assert r.again == (r.text or "")


def test_empty_table(spark, empty, empty_folder):
    assert fim.transform(empty).count() == 0
    assert queries.op13_fill_in_middle(spark, empty_folder).count() == 0
