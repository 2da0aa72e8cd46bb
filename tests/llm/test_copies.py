"""SimHash, passages, lines and components against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from caseflow.llm import components, lines, queries, simhash, windows


def classes(nodes, edges):
    """Smallest reachable node of each node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 20)], [(5, 3), (3, 5), (9, 8), (8, 2)]])
def test_components(spark, edges):
    df = spark.createDataFrame([*edges, (None, 4)], "a long, b long")
    want = classes({x for e in edges for x in e}, edges)
    got = {r.node: r.root for r in components.components(df, "a", "b").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: want[n] for n in linked}


def test_fingerprint_by_hand():
    from xxhash import xxh64_intdigest

    text = "One two\tTHREE four\x0bfive É"
    words = ["one", "two", "three", "four", "five", "É"]
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 4)
    assert simhash.fingerprint_of(text) == want
    assert simhash.fingerprint_of("Ab  c") == xxh64_intdigest(b"ab c", 42)
    assert simhash.fingerprint_of(None) == simhash.fingerprint_of(" \n") == 0


def test_long_text_in_parts(monkeypatch):
    text = " ".join(map(str, range(500)))
    want = simhash.fingerprint_of(text)
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    assert simhash.fingerprint_of(text) == want


def test_pivot_join_finds_every_close_pair(spark):
    rng = random.Random(2)
    points = {0}
    for _ in range(60):
        x = rng.getrandbits(64)
        points.add(x)
        for _ in range(4):
            points.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    points = {p - (1 << 64) if p >> 63 else p for p in points}
    got = {(r.one, r.other) for r in simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in points], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in points for b in points if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert got == want and len(want) > 50


def test_simhash_query(spark, folder, rows):
    prints = [(i, simhash.fingerprint_of(t)) for i, t, *_ in rows]
    distinct = sorted({f for _, f in prints})
    root = classes(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for i, f in prints:
        least[root[f]] += [i] if i is not None else []
    want = sorted(((i, f"{f:016x}", min(least[root[f]], default=None)) for i, f in prints), key=str)
    got = sorted((tuple(r) for r in queries.op4_simhash(spark, folder).collect()), key=str)
    assert got == want


def test_keep_one_of_each_component(spark, table, rows, folder):
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    ids = {r.component_id for r in queries.op4_simhash(spark, folder).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(ids)


def test_nameless_components_stay(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "some other words here")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(df).collect()) == ["a b c", "some other words here"]


def edit_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def expected_lines(docs):
    """Numbers of the lines that go, by id."""
    found = [(i is None, i or 0, k, tuple(x.lower().split())) for i, t in docs for k, x in enumerate((t or "").split("\n"))]
    seen, gone = {}, defaultdict(set)
    for none, i, k, w in sorted(x for x in found if len(x[3]) >= lines.LEAST):
        if w not in seen:
            seen[w] = len(w) >= lines.NEAR and any(len(v) >= lines.NEAR and abs(len(v) - len(w)) < 2 and edit_distance(v, w) <= 1 for v in seen)
            if not seen[w]:
                continue
        gone[None if none else i].add(k)
    return gone


def test_line_decisions(spark, tmp_path):
    rng = random.Random(3)
    base = [[rng.choice("abcdef") for _ in range(rng.randint(1, 14))] for _ in range(40)]

    def changed(w):
        w = list(w)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            p, kind = rng.randrange(len(w) + 1), rng.choice("ird")
            w[p : p + (kind != "i")] = [] if kind == "d" else [rng.choice("abcdef")]
        return " ".join(w)

    docs = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(0, 6)))) for i in range(90)]
    docs += [(1000, None), (1001, ""), (None, "A b c D e f a b  c d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: set(r.removed) for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    want = expected_lines(docs)
    assert got == {i: want.get(i, set()) for i, _ in docs} and sum(map(len, want.values())) > 50


def test_apply_removes_lines_and_empty_documents(spark):
    docs = [(1, "one two three\nkeep me please"), (2, "One  two three\nother line here"), (3, "one two three"), (4, None), (5, "")]
    out = lines.apply(spark.createDataFrame([(i, t, "l", "h") for i, t in docs], "doc_id long, text string, lines string, hash string"))
    got = {r.doc_id: (r.text, r.lines) for r in out.collect()}
    assert got == {1: (docs[0][1], "l"), 2: ("other line here", "l"), 4: (None, "l"), 5: ("", "l")}


def test_short_lines_and_lines_without_spaces(spark):
    """Lines of one word are compared, edits of long lines of few words too, by characters in one word."""
    chinese = "".join(chr(0x4E00 + 7 * i) for i in range(30))
    first = ["Read more", "Advertisement", chinese, "Copyright 2019 Example Inc", "a b c d e f g h i j k l m n o p q r s t", "one two six"]
    later = ["read  more", "ADVERTISEMENT", chinese[:12] + chinese[13:], "Copyright 2020 Example Inc", "abcdefghijklmnopqrst", "one two ten", chinese[:9]]
    docs = spark.createDataFrame([(1, "\n".join(first)), (2, "\n".join(later)), (3, "?\n\n \n?")], "doc_id long, text string")
    assert {r.id: r.lines for r in lines.removed_lines(docs).collect()} == {2: [0, 1, 2, 3], 3: [3]}


def test_repeated_rows_are_one_document(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 3 + [(2, "one two three")], "doc_id long, text string")
    assert [r.doc_id for r in lines.apply(docs).collect()] == [1, 1, 1]


def test_one_edit():
    for a, b, same in (("abc", "abc", True), ("abc", "abd", True), ("abc", "bc", True), ("", "a", True), ("abc", "acb", False), ("ab", "abcd", False)):
        assert lines.within_one_edit(list(a), list(b)) is same is lines.within_one_edit(list(b), list(a))


def test_compact_windows_cover_every_passage():
    import numpy as np

    rng = np.random.default_rng(4)
    for values in (rng.integers(0, 30, 60), np.zeros(60, int)):
        found = windows.compact_windows(values.astype(np.uint64), 10)
        for i in range(60):
            for j in range(i + 9, 60):
                hit = [c for left, c, right in found if left <= i <= c <= j <= right]
                assert len(hit) == 1 and values[hit[0]] == values[i : j + 1].min()
        assert {int(values[c]) for _, c, _ in found} == set(windows.least_values(values.astype(np.uint64), 10).tolist())


def test_passages(spark, folder, rows):
    prints = {}
    for i, t, *_ in rows:
        prints.setdefault(t, windows.shingles(t))
    texts = list(prints)
    edges = []
    for x, a in enumerate(texts):
        for b in texts[:x]:
            one, other = prints[a], prints[b]
            at = {s: k for k, s in enumerate(other.tolist())}
            shifts = Counter(at[s] - k for k, s in enumerate(one.tolist()) if s in at)
            if any(windows.alike(one, other, d, 46, 0.8) for d in shifts):
                edges.append((texts.index(b), x))
    root = classes(range(len(texts)), edges)
    named = defaultdict(list)
    for i, t, *_ in rows:
        named[root[texts.index(t)]] += [i] if i is not None else []
    want = sorted(((i, min(named[root[texts.index(t)]])) for i, t, *_ in rows), key=str)
    got = queries.op3_passages(spark, folder).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == want and len(edges) >= 10
    planted = {i for i, *_ in rows[-8:-3]}
    ranges = [tuple(map(int, r.passages.split(":"))) for r in got if r.doc_id in planted]
    assert len(ranges) == 5 and all(15 <= a <= 20 and 80 <= b <= 85 for a, b in ranges)


def passage_words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_passages_with_repeated_phrases():
    """Every place of a shingle counts: short phrases repeated, and lines that also stand apart before."""
    rng = random.Random(8)
    for period in (1, 3, 5, 70):
        phrase = " ".join([passage_words(rng, period)] * -(-60 // period))
        n = len(phrase.split())
        one, other = (windows.shingles(f"{passage_words(rng, k)} {phrase} {passage_words(rng, 30)}") for k in (20, 33))
        for found, k in zip(windows.shared_passages(one, other, 46, 0.8), (20, 33)):
            assert len(found) == 1 and k - 5 <= found[0][0] <= k and k + n - 4 <= found[0][1] <= k + n + 1
    first, second = passage_words(rng, 25), passage_words(rng, 25)
    one = windows.shingles(f"{passage_words(rng, 9)} {first} {second} {passage_words(rng, 9)}")
    other = windows.shingles(f"{second} {passage_words(rng, 30)} {first} {passage_words(rng, 30)} {first} {second}")
    assert all(windows.shared_passages(one, other, 46, 0.8)) and all(windows.shared_passages(other, one, 46, 0.8))


def test_repeated_stretches_against_every_diagonal():
    import numpy as np

    rng = np.random.default_rng(9)
    for k in range(150):
        part = np.tile(rng.integers(0, 9, 7 if k % 3 else 90), 40 if k % 3 else 2)
        one, other = (np.concatenate((rng.integers(0, 60, rng.integers(0, 60)), part[: rng.integers(20, 280)], rng.integers(0, 60, 50))) for _ in range(2))
        want = [r for d in range(-len(one), len(other)) for r in windows.alike(one, other, d, 46, 0.8)]
        assert windows.joined([r[:2] for r in windows.repeated(one, other, 46, 0.8)]) == windows.joined(want)


def test_passages_behind_a_frequent_sentence(spark):
    """Pairs that share a passage are found although its least hashes lie in a sentence of many texts."""
    rng = random.Random(10)
    sentence = passage_words(rng, 42)
    texts = [f"{passage_words(rng, 20)} {sentence} {passage_words(rng, 20)}" for _ in range(60)]
    for _ in range(10):
        before, after = passage_words(rng, 4), passage_words(rng, 4)
        texts += [f"{passage_words(rng, 20)} {before} {sentence} {after} {passage_words(rng, 20)}" for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in windows.repeated_passages(docs).collect()}
    for i in range(60, 80, 2):
        for k in (i, i + 1):
            assert got[k].class_id == i and [(p.start, p.end) for p in got[k].passages] and got[k].n_links == 1
    assert all(got[i].class_id == i and not got[i].passages for i in range(60))


def test_links_of_few_texts_are_all_counted(spark):
    rng = random.Random(11)
    passage = passage_words(rng, 60)
    docs = [(i, f"{passage_words(rng, 20)} {passage} {passage_words(rng, 20)}") for i in range(7)] + [(i, passage_words(rng, 80)) for i in (8, 9)]
    got = {r.doc_id: r.n_links for r in windows.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(7), 6), 8: 0, 9: 0}


def test_passages_alike_in_large_groups(spark):
    """Pairs that share fifty words but one, most of them a sentence of many texts, are in one class."""
    rng = random.Random(12)
    sentence = passage_words(rng, 42)
    texts = [f"{passage_words(rng, 20)} {sentence} {passage_words(rng, 20)}" for _ in range(40)]
    for _ in range(8):
        before, after = passage_words(rng, 4), passage_words(rng, 3)
        texts += [f"{passage_words(rng, 20)} {before} {sentence} {passage_words(rng, 1)} {after} {passage_words(rng, 20)}" for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (512, 7):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(windows, "BLOCK", block)
            got = {r.doc_id: r for r in windows.repeated_passages(docs).collect()}
        assert all(got[i].class_id == i - i % 2 and got[i].n_links == 1 for i in range(40, 56))
        assert all(got[i].class_id == i and not got[i].n_links for i in range(40))


def test_common_places(monkeypatch):
    import numpy as np

    monkeypatch.setattr(windows, "VALUES_AT_ONCE", 3)
    lists = [[1, 1, 2, 9], [2, 2, 5], [7], [9, 1, 5, 5, 5], [1, 8, 1, 8, 1, 8, 1, 8, 1, 8, 1, 8, 1, 8, 1, 8]]
    nth, _ = windows.places(np.array([len(x) for x in lists]))
    want = [[sum(v in other for v in one) for other in lists] for one in lists]
    want[4][0], want[4][3] = 8, 7  # one place of the other is within three of seven places
    assert windows.common_places(nth, np.concatenate(lists), 5).tolist() == want
    # Far apart, a value counts as often as in the other list.
    assert windows.common_places(np.repeat([0, 1], [11, 2]), np.array([*range(10), 0, 0, 1]), 2).tolist() == [[11, 2], [2, 2]]


def test_empty_tables(spark, empty_folder):
    for name in ("op3_passages", "op4_simhash", "op6_line_dedup"):
        assert queries.QUERIES[name](spark, empty_folder).collect() == []


def test_links_of_large_groups_are_all_counted(spark):
    """40 texts hold one passage, and those of each third another one that is only alike."""
    rng = random.Random(23)
    passage, kinds = passage_words(rng, 60), [passage_words(rng, 60).split() for _ in range(3)]
    docs = []
    for i in range(40):
        own = list(kinds[i % 3])
        own[rng.choice((0, 59))] = f"x{i}"
        docs.append((i, f"{passage_words(rng, 30)} {passage} {passage_words(rng, 30)} {' '.join(own)} {passage_words(rng, 9)}"))
    got = windows.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 39)}
    assert all(len(r.passages) == 2 for r in got)
