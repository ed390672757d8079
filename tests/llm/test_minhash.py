"""Sets, signatures and components against brute force; stars that need another centre; odd rows."""

import re

import numpy as np
import pytest

from worklens.llm import minhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain(rows, percent=85):
    """[(n, component)] of [(doc_id, text)] by comparing every pair."""
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[top(i)] = top(j)
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(top(i), []).append(d)
    least = {g: min((d for d in m if d is not None), default=None) for g, m in members.items()}
    return [(d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, **changes):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, **changes).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        plain(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def words(rng, n, vocabulary=4000):
    return [f"w{i}" for i in rng.integers(vocabulary, size=n)]


def changed(rng, own, n):
    own = list(own)
    for i in rng.choice(len(own), size=n, replace=False):
        own[i] = f"x{rng.integers(10**9)}"
    return own


def test_sets():
    texts = ["", "  ", "One", "one two", "ONE two\nthree", "a b c a b c a b c", "é Ä b", "a b c d e"]
    hashes, first = minhash.shingle_sets([t.encode() for t in texts])
    assert np.diff(first).tolist() == [len(plain_set(t)) for t in texts]
    again, _ = minhash.shingle_sets([b"one TWO three", b"three two one"])
    assert again[0] == hashes[first[4]] and again[1] != again[0]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for n in (8, 40, 200, 2000):
        agree, true = [], []
        for _ in range(60):
            pool = rng.integers(1 << 62, size=n + n // 8, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[n // 8:])
            sig, own = minhash.signatures(
                np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            agree.append((sig[0] == sig[1]).mean())
            true.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
            packed = minhash.packed(sig, own)
            may, share = minhash.may_link(packed[0], packed[1], len(a), len(b))
            assert true[-1] < 0.85 or may
            assert abs(share - true[-1]) < 0.13
        assert abs(np.mean(agree) - np.mean(true)) < 0.05


def test_families(spark):
    """Copies, near copies about the threshold and chains, against every pair."""
    rng = np.random.default_rng(2)
    rows, number = [], 0
    for size in (5, 9, 30, 60, 200):
        for _ in range(8):
            base = words(rng, size)
            for _ in range(6):
                rows.append((number, " ".join(changed(rng, base, int(rng.integers(0, max(2, size // 20)))))))
                number += 1
            chain = base
            for _ in range(4):
                chain = changed(rng, chain, max(1, size // 50))
                rows.append((number, " ".join(chain).upper()))
                number += 1
    check(spark, rows)


def test_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("short", [0, 230, 1000])
def test_centres_step_aside(spark, short):
    """Many texts share a bucket (a band of one bin) with a centre none of them is linked to."""
    rng = np.random.default_rng(3)
    common = words(rng, 120)
    rows = []
    for i in range(40):  # twenty linked pairs, similar to all others but not enough
        own = common + (words(rng, 100) if i % 2 == 0 else [])
        if i % 2:
            own = changed(rng, rows[-1][1].split(), 2)
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.components_of(df, rows=1, block=7, short=short).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(d, c) for d, _, c in plain(rows)]


def test_pairs_of_long_texts_stay_in_their_task(spark):
    """A bucket of long texts, linked or almost, sends no more rows than it has members."""
    rng = np.random.default_rng(6)
    rows = []
    for family, n in enumerate((4, 11)):  # similar by about 0.93: all linked; by about 0.84: hardly any
        base = words(rng, 700, 10**6)
        rows += [(family * 100 + i, " ".join(changed(rng, base, n))) for i in range(40)]
    check(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = minhash.described(df).selectExpr("doc_id id", "n", "sig", "text_key key", "hi", "lo")
    nodes = minhash.saved(nodes)
    live = minhash.saved(minhash.buckets(nodes).selectExpr("*", "id root"))
    assert minhash.across(live, nodes, df).count() < 4 * len(rows)  # of 1,560 pairs


def test_odd_rows(spark):
    long = " ".join(words(np.random.default_rng(4), 60_000))
    check(spark, [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (None, "a"), (None, ""),
                  (6, "a b"), (7, "a b c"), (8, long), (9, long + " more"), (9, long), (3, "a"),
                  (None, "p q r s"), (None, "p q r s")])
    check(spark, [])
    check(spark, [(1, None)])


def test_hot_copies(spark):
    rng = np.random.default_rng(5)
    hot = " ".join(words(rng, 50))
    check(spark, [(i, hot if i % 3 == 0 else " ".join(words(rng, 50))) for i in range(600)])


def test_filter(spark):
    rows = [(3, "a b c d", 1, "p"), (2, "A b c d", 2, "q"), (4, "x y", 3, "r"), (4, "x y", 3, "r"),
            (5, "", 4, "s"), (6, None, 5, "t"), (None, "k l m", 6, "u"), (None, "n o p", 7, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root int, key string")
    kept = minhash.filter_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.key for r in kept.collect()) == ["q", "r", "s", "t", "u", "v"]
