"""Distances, order and recall against brute force; the heap against a full sort; odd vectors."""

import numpy as np
import pytest

from worklens.llm import ann


def brute(ids, points, q, k=10):
    d = np.sqrt(((points - points[ids.index(q)]) ** 2).sum(axis=1))
    order = sorted((float(x), i) for x, i in zip(d, ids) if i != q)[:k]
    return [(i, x) for x, i in order]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    ids, points = list(rows), np.array(list(rows.values()), dtype=np.float64)
    found = {}
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert set(found) == {i for i in ids if i % 100 == 0}
    hits = 0
    for q, got in found.items():
        true = brute(ids, points, q)
        assert len(got) == 10 and [x for _, x in got] == sorted(x for _, x in got)
        hits += len({i for i, _ in true} & {i for i, _ in got})
        for i, score in got:
            d = np.sqrt(((points[ids.index(i)] - points[ids.index(q)]) ** 2).sum())
            assert score == pytest.approx(d, rel=1e-13)
    assert hits / (10 * len(found)) >= 0.9


def test_exact_search_is_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    ids, points = list(rows), np.array(list(rows.values()), dtype=np.float64)
    for r in ann.exact(df).collect():
        i, score = brute(ids, points, r.query_id)[r.rank - 1]
        assert (r.vec_id, r.score) == (i, pytest.approx(score, rel=1e-13))


def test_cells_come_in_order():
    rng = np.random.default_rng(0)
    left, right = rng.random((7, 3)), rng.random((9, 3))
    index = ann.Index(left, right, rng.integers(0, 3, size=63))
    for query in rng.random((20, 6)):
        total = (((query[:3] - left) ** 2).sum(1)[:, None] + ((query[3:] - right) ** 2).sum(1)).ravel()
        order = [int(c) for c in np.argsort(total) if index.count[c]]
        assert ann.visited(query, index, 10**9) == order
        some = ann.visited(query, index, 10)
        assert some == order[:len(some)] and index.count[some].sum() >= 10


def test_hot_cell(spark):
    """A third of the rows is one vector; its cell is dealt over several shards."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.random(4).tolist(), 0) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.search(df, shard=64).collect()}
    assert [got[300, k] for k in range(1, 11)] == [(3 * i, 0.0) for i in range(10)]
    assert len(got) == 150


@pytest.mark.parametrize("block", [1, 7, 40, 8192])
def test_blocks_of_queries_change_nothing(spark, block):
    """Shards go only to the blocks that ask for them; every block size gives the same rows."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 6)) * 10
    rows = [(i, (centres[i // 100 % 20] + rng.normal(size=6)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, enough=400, shard=256, block=block).collect()
    wanted = ann.search(df, enough=400).collect()
    assert len(got) == 400 and sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_cells_as_bits():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 300):
        cells, to = rng.integers(0, 5000, size=n), rng.integers(0, 4, size=n)
        shards, bits = ann.cell_bits(cells, to)
        assert shards.tolist() == sorted(set(to.tolist())) and len(bits) == len(shards)
        for shard, (lowest, flags) in zip(shards, bits):
            every = np.arange(5000)
            assert every[ann.has_bit(every, lowest, flags)].tolist() == sorted(set(cells[to == shard]))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (200, None), (300, [0.0, 0.0]),
            (400, [1.0, None]), (500, [nan, 1.0]), (600, [inf, 1.0]), (700, [1.0]), (None, [1.0, 1.0]),
            (1, [1.0, 0.0]), (2, [1.0, 0.0]), (800, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {(r.query_id, r.rank): r.vec_id for r in ann.search(df).collect()}
    assert out == {(0, 1): 1, (0, 2): 2, (0, 3): 100, (100, 1): 0, (100, 2): 1, (100, 3): 2}
    assert ann.search(df.where("false")).count() == 0
    assert ann.search(df.where("vec_id = 0")).count() == 0
