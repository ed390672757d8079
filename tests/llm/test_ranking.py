"""Held-out accuracy, pairs against their definition, features against plain code, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklens.llm import ranking


def area_under_curve(score, label):
    good, bad = score[label == 1], score[label == 0]
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)


@pytest.mark.parametrize("sf,least", [("sf0.01", 0.9), ("sf0.1", 0.95)])
def test_held_out(spark, sf, least):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    out = ranking.classify(docs.select("doc_id", "text"), labels)
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    score, predicted, quality = (np.array(x) for x in zip(*rows))
    assert ((score >= 0) & (score <= 1)).all() and ((score >= 0.7) == predicted).all()
    assert area_under_curve(score, quality) > least
    assert (predicted == quality).mean() > 0.85
    assert out.count() == docs.count()


def test_features():
    rows = ranking.features([b"", b"Aa AA | 12 12\nx!", b"w " * 100])
    assert np.isfinite(rows).all() and rows.shape[0] == 3
    n = 6
    assert rows[1][0] == np.log1p(n) and rows[0][0] == 0
    assert rows[1][3] == 3 / 16 and rows[1][9] == 1 / 16  # capitals, line feeds
    assert rows[2][11] == 99 / 100 and rows[2][12] == 99 / 100 and rows[2][13] == 97 / 100
    assert np.allclose(rows[1], ranking.features([b"Aa AA | 12 12\nx!"])[0])


def test_pairs(spark):
    rows = [(i, int(i % 3 > 0), [float(i)]) for i in range(300)]
    df = ranking.saved(spark.createDataFrame(rows, "key long, quality int, x array<double>"))
    pairs = ranking.pairs_of(df, 4).collect()
    assert 4 * 100 < len(pairs) < 4 * 300  # documents, not their product
    assert {r.label for r in pairs} == {0.0, 1.0}


def test_learned_labels_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = labels.withColumn("quality", F.when(
        ranking.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: round(r.score, 9) for r in ranking.classify(docs, x).collect()}
            for x in (labels, other))
    assert a == b


def test_edges(spark):
    rows = [(1, None, 0.0), (2, "", 0.0), (3, "word " * 50_000, 0.0), (None, "b c", 0.0), (4, "x", 0.0),
            (4, "x", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in ranking.classify(df, none).collect()} == {(0.5, 0)}
    some = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (4, 0, 1), (9, None, 0), (5, 1, 0)],
                                 "doc_id long, quality int, toxic int")
    out = ranking.classify(df, some).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert ranking.classify(df.where("false"), some).count() == 0


def test_hot_document_counts_once(spark, monkeypatch):
    """A labelled doc_id in most rows neither outweighs the others nor reaches the driver."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.where("quality is not null").select("doc_id").orderBy("doc_id").first()[0]
    hot = spark.range(20_000).select(
        F.lit(known).alias("doc_id"), F.concat(F.lit("hot "), F.col("id").cast("string")).alias("text"))
    sent = []
    pairs_of = ranking.pairs_of
    monkeypatch.setattr(ranking, "pairs_of", lambda x, *a: sent.append(x.count()) or pairs_of(x, *a))
    ranker = ranking.learn(docs.unionByName(hot), labels)
    plain = ranking.learn(docs, labels)
    assert sent[0] == sent[1] and len(ranker.weights) == len(plain.weights)
    again = ranking.learn(docs.unionByName(docs).unionByName(docs), labels)
    assert again == plain


def test_every_labelled_document_is_learned(spark, monkeypatch):
    """No label is left out, however many there are, and no partitioning changes the result."""
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.when(F.col("id") % 3 == 0, "A||B ## ").otherwise("plain words "),
                 F.repeat(F.lit("w "), (F.col("id") % 7).cast("int"))).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 > F.col("doc_id") % 2).cast("int").alias("quality"))
    met = []
    pairs_of, threshold_of = ranking.pairs_of, ranking.threshold_of
    monkeypatch.setattr(ranking, "pairs_of", lambda x, *a: met.append(x.count()) or pairs_of(x, *a))
    monkeypatch.setattr(ranking, "threshold_of", lambda x, *a: met.append(x.count()) or threshold_of(x, *a))
    ranker = ranking.learn(docs, labels)
    assert met == [24_000, 24_000]
    assert ranking.learn(docs.repartition(7), labels.repartition(3)) == ranker
    monkeypatch.setattr(ranking, "IDS", 10)
    monkeypatch.setattr(ranking, "RARE", 10)
    assert ranking.learn(docs, labels) == ranker


def test_weights_maximise_the_likelihood(spark):
    """Against plain Newton steps over all pairs at once."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [1, 10, 0]
    label = (rng.random(500) < 1 / (1 + np.exp(-x @ [1, -0.2, 0]))).astype(float)
    df = ranking.saved(spark.createDataFrame(list(zip(label.tolist(), x.tolist())),
                                             "label double, features array<double>"))
    w = ranking.weights_of(df)
    p = 1 / (1 + np.exp(-x @ w))
    slope = (label - p) @ x / 500 - ranking.PENALTY * w * (x * x).mean(axis=0)
    assert np.allclose(slope, 0, atol=1e-6) and w[2] == 0 and abs(w[0]) > 0.5
    huge = df.select("label", F.transform("features", lambda v: v * 1e9).alias("features"))
    assert np.allclose(ranking.weights_of(ranking.saved(huge)) * 1e9, w, atol=1e-6)
