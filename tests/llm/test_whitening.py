"""Polar factors, components and whitened values against plain code; odd vectors."""

import numpy as np
import pytest

from worklens.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows):
    """{(row, component): ...} by numpy's own eigenvectors over exact integers."""
    x = [tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for _, v in rows]
    fit = sorted(set(x))
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    off = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in fit])
    value, vectors = np.linalg.eigh(off.T @ off / n)
    value, vectors = value[::-1], vectors[:, ::-1]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total)) for v in x]
    white = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in x]) @ vectors
    return n, deviation, white, value


def held(spark, rows):
    return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 60, 40), np.repeat([1.0, 5.0, 9.0], 8), np.zeros(6), np.ones(7),
    10.0 ** -np.arange(12), np.append(np.ones(10), np.zeros(10)), np.array([3.0]),
    np.append(np.full(9, 2.0), 2.0 + 1e-13)])
def test_eigen(spectrum):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))[0]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    value, vectors = whitening.eigen(a)
    scale = max(1.0, np.abs(a).max())
    assert np.allclose(value, np.sort(np.linalg.eigvalsh(a))[::-1], atol=1e-13 * scale, rtol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * value).max() < 1e-13 * scale


def test_polar():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    value, vectors = np.linalg.eigh(a)
    assert np.allclose(whitening.polar(a), vectors * np.sign(value) @ vectors.T, atol=1e-12)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_against_plain(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    n, deviation, white, value = plain(rows)
    place = {v: i for i, (v, _) in enumerate(rows)}
    found = whitening.whiten(df).collect()
    assert len(found) == 16 * len(rows)
    got = np.zeros((len(rows), 16))
    for r in found:
        i = place[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[i] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(value[r.component - 1] / value.sum(), rel=1e-9)
    true = white[:, :16] / np.sqrt(value[:16])
    sign = np.sign((got * true).sum(axis=0))
    assert np.abs(got * sign - true).max() < 1e-8


def test_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    fine = [(i, rng.normal(size=5).tolist()) for i in range(200)]
    copies = [(1000 + i, fine[0][1]) for i in range(150)]
    odd = [(5000, None), (5001, [1.0, None, 1.0, 1.0, 1.0]), (5002, [float("nan")] * 5),
           (5003, [float("inf")] * 5), (5004, [1.0, 2.0]), (5005, []), (5006, [1e30] * 5)]
    rows = fine + copies + [fine[3], (None, fine[4][1])]
    got = held(spark, rows + odd)
    n, deviation, white, value = plain(rows)
    assert len(got) == 5 * len(rows) and {r.n for r in got} == {n} == {200}
    assert sorted(r.deviation for r in got) == sorted(d for d in deviation for _ in range(5))
    by = {}
    for r in got:
        by.setdefault((r.component, round(abs(r.whitened), 8)), []).append(r)
    true = np.abs(white / np.sqrt(value))
    assert sorted(round(abs(r.whitened), 6) for r in got) == sorted(np.round(true, 6).ravel().tolist())
    assert sum(r.vec_id is None for r in got) == 5


def test_no_variance(spark):
    assert held(spark, [(1, None)]) == []
    got = held(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert len(got) == 4 and all(r.whitened is None and r.deviation == 0 for r in got)
    got = held(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 9.0])])
    assert [r.whitened is None for r in sorted(got, key=lambda r: (r.component, r.vec_id))] == (
        [False] * 3 + [True] * 3)
    assert {r.explained for r in got if r.component == 1} == {1.0}


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i * 2**40), float(-i), 0.5]) for i in range(1, 9)]
    n, deviation, _, _ = plain(rows)
    got = {r.vec_id: r.deviation for r in held(spark, rows)}
    assert [got[i] for i, _ in rows] == [d if d < 2**63 else None for d in deviation]


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 5, 6), (2, [2.0, 2.0], 5, 6)],
                               SCHEMA + ", x int, component int")
    assert len(whitening.whiten(df).collect()) == 4
