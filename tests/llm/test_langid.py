"""Likelihoods against an enumeration of all segmentations; accuracy on held-out documents."""

import re
import sys
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklens.llm import langid, sentences
from worklens.llm.common import hash_sample_by


@pytest.fixture(scope="module")
def coder():
    return sentences.coder()


def segmentations(coder, word, pieces):
    """Every list of edges, by trying all first pieces."""
    if not word:
        yield []
        return
    first = len(word.decode(errors="ignore")[0].encode())
    single = word[:first] in pieces
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(coder, word[k:], pieces):
                yield [[pieces[word[:k]]], *rest]
    if not single:
        for rest in segmentations(coder, word[first:], pieces):
            yield [[int(coder.byte_id[b]) for b in word[:first]], *rest]


def test_sums_over_all_segmentations(coder):
    from worklens.llm.trie import NORMAL, vocabulary

    v = vocabulary(sentences.VOCABULARY)
    pieces = {t: i for i, t in enumerate(v.text) if v.kind[i] == NORMAL}
    rng = np.random.default_rng(1)
    logp = np.log(rng.random((len(coder.score), 2)))
    words = ["the", "über", "mention", "ꙮa"]
    ours = langid.log_likelihoods((coder.trie, coder.byte_id, logp), words)
    counts = {}
    for i, w in enumerate(words):
        paths = list(segmentations(coder, b" " + w.encode(), pieces))
        each = np.array([sum(logp[x] for part in p for x in part) for p in paths])
        assert np.allclose(ours[i], np.logaddexp.reduce(each, axis=0))
        post = np.exp(each[:, 1] - np.logaddexp.reduce(each[:, 1]))
        for p, q in zip(paths, post):
            for x in (x for part in p for x in part):
                counts[x] = counts.get(x, 0) + 2 * q
    g, piece, c = langid.expected_counts(
        (coder.trie, coder.byte_id, logp), words, np.full(4, 2.0), np.ones(4, np.int64))
    assert set(g) == {1} and {int(p) for p in piece} == set(counts)
    assert np.allclose(c, [counts[int(p)] for p in piece])


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(df).where("held_out")
    assert out.columns == [*df.columns, "held_out", "lang_pred", "score"]
    right, n, low, high = out.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"),
        F.min("score"), F.max("score")).first()
    assert n > 150 and right > 0.97 and 0 <= low <= high <= 1


def test_labels_of_held_out_rows_are_not_used(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = df.withColumn("lang", F.when(langid.is_held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, langid.identify(x).select("doc_id", "lang_pred", "score").collect()))
            for x in (df, other))
    assert a == b


def test_edges(spark):
    rows = [(1, "the and", "en", 1), (2, None, "en", 1), (3, "12 .. 3", "de", 1), (4, "", None, 1),
            (None, "der und", "de", 1), (6, "der " * 30_000, None, 1), (7, "the and", "en", 1),
            (7, "the and", "en", 1), (8, "der und", "de", 1), (11, "der und", "de", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = {(r.doc_id, r.lang_pred) for r in langid.identify(df).collect()}
    assert {(2, "und"), (3, "und"), (4, "und")} <= out and (6, "de") in out and (7, "en") in out
    assert langid.identify(df.where("false")).count() == 0
    kept = langid.filter_documents(df)
    assert kept.columns == df.columns and kept.where("doc_id in (2, 3, 4)").count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_only_letters_are_letters():
    assert langid.words_of("½ ² ³ Ⅷ ٣ _ 12") == []
    assert langid.words_of("a½b Élan x_y ǅ 日本") == ["a", "b", "élan", "x", "y", "ǆ", "日本"]


def test_words_cost_about_as_much_as_a_plain_pattern():
    every = "".join(map(chr, range(sys.maxunicode + 1))).lower()  # each code point, and words of them
    plain = "".join(c if unicodedata.category(c).startswith("L") else " " for c in every).split()
    assert langid.words_of(every) == plain
    text = "Words of ordinary text, größer und élan; " * 5000
    took = {}
    for name, run in (("ours", langid.words_of), ("plain", re.compile(r"[^\W\d_]+").findall)):
        times = []
        for _ in range(3):
            begin = time.perf_counter()
            run(text)
            times.append(time.perf_counter() - begin)
        took[name] = min(times)
    assert took["ours"] < 10 * took["plain"]


def test_repeated_rows_change_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    many = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("n")
    one = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df).collect()}
    assert one == {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(many).collect()}


def test_repeats_leave_the_sample_whole(spark):
    base = spark.range(4000).select(F.lit("x").alias("g"), F.col("id").alias("k"))
    for times in (1, 5, 20):
        many = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("n")
        assert hash_sample_by(many, "g", 300, "k").count() == 300
