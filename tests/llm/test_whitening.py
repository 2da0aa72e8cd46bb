"""Whitening: inertia counts and eigenpairs against a library, the query against plain code."""

import math

import numpy as np
import pytest
from caseflow.llm import queries, whitening
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, x string, id string, v string, length string"


def symmetric(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


SPECTRA = {
    "apart": np.geomspace(1, 100, 20),
    "close": np.array([1, 1 + 1e-7, 1 + 2e-7, 2, 2 + 1e-9, 3, 5, 5, 5, 5 + 1e-12, 8, 9.0]),
    "clusters": np.repeat([1.0, 4.0, 7.0], 6),
    "low rank": np.array([0.0] * 30 + [1, 2, 3]),
    "indefinite": np.linspace(-5, 5, 15),
    "one": np.array([2.5]),
    "far apart": np.array([1e-9, 1e-3, 10.0, 1e6, 1e12]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_counts_equal_the_spectrum(name):
    m = symmetric(SPECTRA[name], 4)
    true = np.linalg.eigvalsh(m)
    gap = 1e-9 * np.abs(true).max()
    for shift in np.concatenate((np.linspace(true[0] - 1, true[-1] + 1, 41), true[:-1] + np.diff(true) / 2)):
        if np.abs(true - shift).min() > gap:
            assert whitening.inertia_above(m, shift) == (true > shift).sum()
    assert whitening.inertia_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("name", [n for n in SPECTRA if n != "indefinite"])
@pytest.mark.parametrize("seed", range(3))
def test_leading_pairs(name, seed):
    m = symmetric(SPECTRA[name], seed)
    true = np.linalg.eigvalsh(m)[::-1]
    found = whitening.leading(m, 8)
    k = min(8, int((true > 1e-12 * true.sum()).sum()))
    assert len(found.values) == k
    assert np.allclose(found.values, true[:k], rtol=0, atol=1e-12 * true[0])
    assert np.abs(found.vectors @ found.vectors.T - np.eye(k)).max() < 1e-9
    assert np.abs(m @ found.vectors.T - found.vectors.T * found.values).max() < 1e-11 * true[0]
    assert all(above < i <= until for i, (above, until) in enumerate(found.counts, 1))


def plainly(rows):
    """{vec_id: (deviation, [|whitened|])}, n and explained, by a library's eigenvectors."""
    good = [(i, v) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good], dtype=object)
    n, sums = len(x), x.sum(0)
    centred = np.array(x - 0, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    order = [i for i in order if values[i] > 1e-12 * values.sum()]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((n * x - sums) ** 2).sum(1)
    return n, [(i, int(d), w) for (i, _), d, w in zip(good, deviation, white)], values[order] / values.sum()


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    scale = np.linspace(0.1, 0.5, d)
    return [(i, [float(c) for c in rng.standard_normal(d) * scale], "a", "b", "c", "d") for i in range(n)]


def check(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op11_whitening(spark, str(tmp_path)).collect()
    n, want, explained = plainly(rows)
    assert len(got) == len(want) * len(explained)
    signs = {}
    by_row = {}
    for r in got:
        by_row.setdefault((str(r.vec_id), r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-4 and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    for vec_id, deviation, w in want:
        for k, value in enumerate(w):
            r = by_row[str(vec_id), deviation][k + 1][0]
            sign = signs.setdefault(k, np.sign(r.whitened * value)) if abs(value) > 0.1 else signs.get(k)
            assert abs(r.whitened) == pytest.approx(abs(value), abs=1e-6)
            assert sign is None or abs(value) < 1e-6 or np.sign(r.whitened * value) == sign
    return got


def test_query_equals_plain_code(spark, tmp_path):
    rows = vectors(1, 300, 12)
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, *"abcd"), (901, [], *"abcd"), (902, [0.1, None] * 6, *"abcd"), (903, [nan] * 12, *"abcd"), (904, [0.5] * 11 + [inf], *"abcd")]
    rows += [(None, rows[4][1], *"abcd"), rows[7], (7, rows[8][1], *"abcd")]
    check(spark, tmp_path, rows)


def test_fewer_dimensions_than_components(spark, tmp_path):
    assert {r.component for r in check(spark, tmp_path, vectors(2, 60, 3))} == {1, 2, 3}


def test_nothing_to_whiten(spark, tmp_path):
    for i, rows in enumerate(([], vectors(3, 1, 5), [vectors(3, 1, 5)[0]] * 4, [(1, None, *"abcd")])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{i}/embeddings.parquet")
        found = queries.op11_whitening(spark, f"{tmp_path}/{i}")
        assert found.count() == 0 and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_lengths_are_dropped(spark):
    rows = vectors(5, 40, 6) + [(100 + i, [0.1] * 5, *"abcd") for i in range(10)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).withColumn("component", F.lit(1)))
    assert {r.vec_id for r in found.collect()} == set(range(40))


def test_deviations_are_exact():
    x = np.array([[100_003, 99_991], [100_000, 100_500]])
    assert whitening.deviations(x, 10**6, [100_001 * 10**6, 100_100 * 10**6 + 7]) == [(10**6 * 2) ** 2 + (-109 * 10**6 - 7) ** 2, (-(10**6)) ** 2 + (400 * 10**6 - 7) ** 2]
    assert whitening.deviations(x, 10**12, [0, 0]) == [None, None]
    n = 40_000_000
    assert whitening.deviations(np.array([[100_050]]), n, [100_000 * n + 3]) == [(50 * n - 3) ** 2]
