"""Positives and negatives against plain code; bounds; bounded visits; odd rows."""

import numpy as np
import pytest

from worklens.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows):
    """The contract in plain Python over (vec_id, embedding, label)."""
    fine = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all():
            moved = (label + 1) % 10 if i % 7 == 0 else label
            own = (moved, [int(np.floor(256 * c)) for c in v])
            fine[i] = min(own, fine.get(i, own))
    out = []
    for a, (label, q) in fine.items():
        if a % 50:
            continue
        scored = sorted((-sum(p * x for p, x in zip(q, v)), i, other)
                        for i, (other, v) in fine.items() if i != a)
        for score, p, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score]
            out += [(a, p, rank, n, -score, -s) for rank, (s, n, _) in enumerate(window[:3], 1)]
    return sorted(out)


def check(spark, rows, **changes):
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA), **changes).collect()
    assert sorted(map(tuple, got)) == plain(rows)
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = negatives.mine(df).collect()
    assert sorted(map(tuple, got)) == plain(rows) and got


def test_visits_and_blocks(spark):
    """Several visits of anchors over small blocks; ties and negative scores."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-3, 4, size=6) / 4).tolist(), int(rng.integers(3))) for i in range(1500)]
    assert check(spark, rows, anchors=8, block=50)


def test_hot_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.25, 0.5] if i % 3 else rng.normal(size=3).tolist(), i % 4 and 1)
            for i in range(900)]
    check(spark, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.random(4).tolist(), i % 2) for i in range(0, 300, 5)]
    odd = [(50, None, 1), (None, [1.0] * 4, 1), (901, [1.0] * 4, None), (902, [1.0, None, 1.0, 1.0], 1),
           (903, [float("nan")] * 4, 0), (904, [float("-inf")] * 4, 0), (905, [], 1), rows[4], rows[4],
           (100, [9.0, 1.0, 1.0, 1.0], 0)]
    check(spark, rows + odd)
    assert check(spark, rows + [(950, [1.0, 2.0], 1), (951, [1e30] * 4, 1)][:0]) is not None
    short = negatives.mine(spark.createDataFrame(
        rows + [(950, [1.0, 2.0], 1), (951, [1e30] * 4, 1)], SCHEMA)).collect()
    assert sorted(map(tuple, short)) == plain(rows)
    check(spark, [])
    check(spark, [(50, [1.0], 1), (100, [1.0], 1), (3, [1.0], 2)])


def test_large_values_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.random(3) * 2**20).tolist(), i % 2) for i in range(0, 500, 5)]
    assert check(spark, rows)


def test_extra_columns(spark):
    rows = [(50, [1.0, 1.0], 1, 5, 6), (3, [0.9, 1.0], 1, 5, 6), (4, [0.5, 1.0], 2, 5, 6)]
    df = spark.createDataFrame(rows, SCHEMA + ", rank int, x int")
    assert len(negatives.mine(df).collect()) == 1


def test_bounds_prune():
    """Only few candidates are left for the last dimensions of a far-reaching query."""
    rng = np.random.default_rng(5)
    x = rng.integers(-100, 100, size=(64, 2000))
    x[:16] *= 50
    block = negatives.Block(np.arange(2000), np.zeros(2000), x, x.min(axis=1), x.max(axis=1))
    query = np.where(np.arange(64) < 16, 5000, 10)
    left = []

    def wanted(rows, least, most):
        exact = query @ x[:, rows]
        assert (least <= exact).all() and (exact <= most).all()
        left.append(len(rows))
        return most >= negatives.kth_largest(least, 5)

    rows, score = negatives.bounded_scores(query, block, np.ones(2000, bool), wanted)
    assert left[0] == 2000 and left[1] < 100
    assert set(np.argsort(-(query @ x), kind="stable")[:5]) <= set(rows)
    assert (score == query @ x[:, rows]).all()
