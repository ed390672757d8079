"""Fingerprints, links and components against all pairs on small tables."""

import numpy as np
import pytest
import xxhash

from worklens.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    least = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_real_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    wanted = plain_components([r.doc_id for r in rows], fps)
    out = simhash.near_duplicates(df).orderBy("doc_id").collect()
    assert [r.fingerprint for r in out] == [f"{f:016x}" for f in fps]
    assert [r.component_id for r in out] == wanted
    assert len(set(wanted)) < len(wanted)
    kept = simhash.filter_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted))


@pytest.mark.parametrize("shard,largest", [(8, 1000), (40, 32), (1000, 16)])
def test_links_of_close_points(spark, shard, largest):
    """Balls of close points, so that many lie on the surfaces; small shards and cut shards."""
    rng = np.random.default_rng(5)
    points = set()
    for centre in rng.integers(1 << 63, size=12):
        for _ in range(25):
            flips = rng.choice(63, size=rng.integers(0, 5), replace=False)
            points.add(int(centre) ^ sum(1 << int(b) for b in flips))
    points |= {int(x) for x in rng.integers(1 << 63, size=150)}
    points = sorted(points)
    df = simhash.saved(spark.createDataFrame([(p,) for p in points], "fp long").repartition(4))
    roots = {r.point: r.root for r in simhash.components(
        simhash.links(df, shard, largest)).collect()}
    assert [roots.get(p, p) for p in points] == plain_components(points, points)


def test_every_close_pair_meets_once():
    rng = np.random.default_rng(2)
    centres = rng.integers(1 << 63, size=40, dtype=np.uint64)
    points = np.unique(np.concatenate([centres, centres ^ np.uint64(5), centres ^ np.uint64(1 << 40),
                                       rng.integers(1 << 63, size=200, dtype=np.uint64)]))
    levels = simhash.plant(points, len(points), 8)
    at, shard, side = simhash.placed(points, levels)
    met = {}
    for s in np.unique(shard):
        own = np.flatnonzero(shard == s)
        for i in own:
            for j in own:
                x, y = at[i], at[j]
                if x < y and side[i] + side[j] in (0, 3):
                    met[x, y] = met.get((x, y), 0) + 1
    for x in range(len(points)):
        for y in range(x + 1, len(points)):
            if int(points[x] ^ points[y]).bit_count() <= 3:
                assert met.get((x, y)) == 1
    assert max(met.values()) == 1 and len(met) < len(points) ** 2 / 4


def test_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)], "a long, b long").repartition(5)
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_edges(spark):
    rows = [(5, None, 1), (3, "", 1), (9, " \t", 1), (1, "a", 1), (2, "A", 1), (None, "b c", 1),
            (7, "b c", 2), (7, "b c", 2), (8, "w " * 100_000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    out = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert out == {(5, 3), (3, 3), (9, 3), (1, 1), (2, 1), (None, 7), (7, 7), (8, 8)}
    kept = sorted(r.doc_id for r in simhash.filter_documents(df).collect())
    assert kept == [1, 3, 7, 8]
    assert simhash.near_duplicates(df.where("false")).count() == 0


def test_one_row_of_each_component_whatever_its_ids(spark):
    texts = [" ".join(f"{word}{i}" for i in range(40)) for word in ("ant", "bee", "cow", "dog", "eel")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]),  # no ids
            (4, texts[3]), (4, texts[4]), (4, texts[4]), (6, texts[3])]  # an id of two components
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.filter_documents(df).collect()), key=repr)
    assert kept == sorted([(None, t) for t in texts[:3]] + [(4, t) for t in texts[3:]], key=repr)
    assert simhash.components_of(df).select("root").distinct().count() == 5
