"""Targets against plain resharing, taken words against targets, tilted rates against a solver."""

import math
import re

import pytest
from pyspark.sql import functions as F

from worklens.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return target


def check(df, out, slack):
    words = {}
    for r in df.collect():
        words[r.source] = words.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    wanted = plain_targets(words)
    got = out.join(df.select("doc_id", "source").distinct(), "doc_id").groupBy("source").agg(
        F.first("source_size"), F.first("target"), F.sum("taken"), F.max("size")).collect() \
        if "source" not in out.columns else out.groupBy("source").agg(
        F.first("source_size"), F.first("target"), F.sum("taken"), F.max("size")).collect()
    assert {r[0] for r in got} == set(words)
    for source, size, target, taken, largest in got:
        assert size == words[source]
        assert math.isclose(target, wanted[source], rel_tol=1e-9, abs_tol=1e-6)
        assert abs(taken - target) <= slack * largest + 1e-6 * target, (source, taken, target)
    assert out.where("taken > 2 * size or taken != copies * size or copies not in (0, 1, 2)").count() == 0


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_taken_words_meet_targets(docs):
    out = mixing.saved(mixing.mix(docs))
    assert out.count() == docs.count()
    check(docs, out, 1.0)
    again = mixing.mix(docs.repartition(7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_small_cells(docs):
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    hot = hot.withColumn("text", F.when(F.col("source") == "hot", F.lit("a b c d")).otherwise(F.col("text")))
    check(hot, mixing.saved(mixing.mix(hot, cell=16)), 1.0)


def test_each_prefix_of_a_size_gets_its_share(spark):
    """Running sums in two levels are those of one: along sizes and cells, the copies of each size come
    to its expected number within one."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("a b c d")).otherwise(
            F.repeat(F.lit("w "), (F.col("id") % 50).cast("int") + 1)).alias("text"))
    other = rows.limit(1000).withColumn("source", F.lit("t"))
    out = mixing.mix(rows.union(other), cell=8)
    sizes = out.groupBy("source", "size").agg(F.count("*").alias("n"), F.sum("copies").alias("c")).collect()
    for source in ("s", "t"):
        some = [(r["size"], r.n, r.c) for r in sizes if r.source == source]
        mean = sum(s * n for s, n, _ in some) / sum(n for _, n, _ in some)
        goal = out.where(F.col("source") == source).first().target
        low, high = -100.0, 100.0
        for _ in range(200):
            mid = (low + high) / 2
            words = sum(n * s * 2 / (1 + math.exp(-mid * s / mean)) for s, n, _ in some)
            low, high = (mid, high) if words < goal else (low, mid)
        ahead = got = 0.0
        for s, n, c in sorted(some):
            ahead += n * 2 / (1 + math.exp(-mid * s / mean))
            got += c
            assert abs(got - ahead) <= 1, (source, s)


def test_rates_solve_the_dual(spark):
    histogram = spark.createDataFrame(
        [("a", s, n) for s, n in ((1, 5), (10, 3), (40, 2))], "source string, size long, n long")
    for goal in (20.0, 115.0, 200.0, 229.0):
        goals = spark.createDataFrame([("a", 115, goal)], "source string, source_size long, target double")
        r = mixing.tilts(histogram, goals).first()
        low, high = -1e4, 1e4
        for _ in range(200):
            mid = (low + high) / 2
            words = sum(n * s * 2 / (1 + math.exp(min(700, -mid * s / r.mean)))
                        for s, n in ((1, 5), (10, 3), (40, 2)))
            low, high = (mid, high) if words < goal else (low, mid)
        assert math.isclose(r.tilt, mid, rel_tol=1e-3, abs_tol=1e-3)


def test_mixed_documents(docs):
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in copies.items() if v}


def test_edges(spark):
    rows = [(1, None, "a", 1), (2, "", "b", 1), (3, "x y z", None, 1), (None, "x y", "c", 1),
            (5, "one two", "a", 2), (5, "one two", "a", 2), (5, "one two", "a", 3),
            (6, "w " * 100_000, "d", 1), (7, "u v", "B", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    out = mixing.saved(mixing.mix(df))
    assert out.count() == len(rows)
    check(df, out, 1.0)
    mixed = mixing.mix_documents(df)
    assert mixed.count() == out.agg(F.sum("copies")).first()[0]
    assert mixing.mix(df.where("false")).count() == 0
    silent = df.withColumn("text", F.lit(None).cast("string"))
    assert {(r.target, r.taken) for r in mixing.mix(silent).collect()} == {(0.0, 0)}
