"""Verdicts by divergence against plain code: both distances, of the language that fits best."""

import math
from collections import Counter

import pytest
import regex
from caseflow.llm import divergence as D

SF = "/root/testdata/sf0.001"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def distance(p, q):
    def part(x, y):
        return x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
    return math.sqrt(max(0.0, sum((part(x, y) + part(y, x)) / 2 for x, y in zip(p, q))))


def repeated(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    return len({j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)})


def plainly(text, refs):
    """(kept, class_distance, word_distance) by the rules."""
    text = text or ""
    words = WORD.findall(text)
    solid = "".join(words)
    rest = regex.sub(r"\p{Ll}+", "", solid)
    count = {c: len(regex.findall(p, rest)) for c, p in (("upper", r"\p{Lu}"), ("digit", r"\p{N}"), ("mark", r"[.,;:!?'\"()-]"), ("symbol", r"[#*$%&|<>]"))}
    count |= {"lower": len(solid) - len(rest), "space": len(text) - len(solid), "other": len(rest) - sum(count.values())}
    total = max(1, sum(count.values()))
    classes = [count[c] / total for c in D.CLASSES]
    short = Counter(w.lower() for w in words if len(w) <= D.SHORT)
    fits = []
    for r in refs:
        shares = [short[w] / max(1, len(words)) for w in r.words]
        c, w = distance(classes, r.classes), distance([*shares, max(0.0, 1 - sum(shares))], r.word_shares)
        fits.append((max(c / D.MOST_CLASS_DISTANCE, w / D.MOST_WORD_DISTANCE), c, w))
    worst, c, w = min(fits)
    failed = len(words) < D.LEAST_WORDS or 100 * repeated(words) > D.MOST_REPEATED * len(words)
    return not failed and (len(words) < D.JUDGED_WORDS or worst <= 1), c, w


def test_verdicts_equal_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    refs, rest = D.references(docs)
    assert refs and rest is None
    got = {r.doc_id: r for r in D.judge(docs.select("doc_id", "text"), refs).collect()}
    kept = []
    for r in docs.collect():
        verdict, c, w = plainly(r.text, refs)
        own = got[r.doc_id]
        assert (own.class_distance, own.word_distance) == (pytest.approx(c, abs=1e-9), pytest.approx(w, abs=1e-9))
        assert own.kept == verdict
        kept.append(verdict)
    assert 0.5 < sum(kept) / len(kept) < 1


def test_one_language_must_fit_both_ways(spark):
    """Characters of one language and words of another do not make a clean text."""
    upper, lower = [0.0, 0.1, 0.9, 0, 0, 0, 0], [0.9, 0.1, 0.0, 0, 0, 0, 0]
    refs = [D.Reference("a", lower, ["aa"], [0.5, 0.5]), D.Reference("b", upper, ["bb"], [0.5, 0.5])]
    # Longer words differ from each other, so that no window recurs.
    a, b = (" ".join(f"{w} cccc{'xyz'[i % 3] * (i % 17)}" for i in range(40)) for w in ("aa", "bb"))
    texts = [a, b.upper(), a.upper(), b]
    found = D.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), refs).orderBy("doc_id").collect()
    assert [r.class_distance <= D.MOST_CLASS_DISTANCE and r.word_distance <= D.MOST_WORD_DISTANCE for r in found] == [True, True, False, False]
