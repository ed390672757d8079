"""Counts against plain code, the model against a plain Kneser-Ney, both scoring ways, odd rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklens.llm import rules

TEXTS = ["", " ", "a b c a b c\na b c\n\nx\n a b c", "é# é# é# é#\té", "one\ntwo\none\n one \none",
         "<a> |b| $c &d *e %f #g", "w " * 300, "a\x0bb\x0cc\rd\x85e f", "zz", "x y z x y z"]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_counts():
    out = rules.base_counts([t.encode() for t in TEXTS])
    for i, t in enumerate(TEXTS):
        assert {k: int(v[i]) for k, v in out.items()} == plain_counts(t), t


def test_counts_of_real_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    out = rules.base_counts([r.text.encode() for r in rows])
    for i, r in enumerate(rows):
        assert {k: int(v[i]) for k, v in out.items()} == plain_counts(r.text)


def plain_model(texts):
    """Modified Kneser-Ney of order four over characters, by the textbook."""
    counts = {4: Counter()}
    for t in texts:
        s = chr(2) * 3 + t + chr(3)
        counts[4].update(s[i:i + 4] for i in range(len(s) - 3))
    for size in (3, 2, 1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    cuts = {}
    for size, c in counts.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        cuts[size] = []
        for k, fallback in ((1, 0.5), (2, 1.0), (3, 1.5)):
            d = k - (k + 1) * y * n[k + 1] / n[k] if y is not None and n[k] else None
            cuts[size].append(d if d is not None and 0 < d < k else fallback)
    totals, freed = defaultdict(float), defaultdict(float)
    for size, c in counts.items():
        for g, n in c.items():
            totals[size, g[:-1]] += n
            freed[size, g[:-1]] += cuts[size][min(n, 3) - 1]

    def p(gram):
        size = len(gram)
        if not size:
            return 1 / (len(counts[1]) + 1)
        if (size, gram[:-1]) not in totals:
            return p(gram[1:])
        n = counts[size][gram]
        own = n - cuts[size][min(n, 3) - 1] if n else 0.0
        return (own + freed[size, gram[:-1]] * p(gram[1:])) / totals[size, gram[:-1]]

    return p


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, t, "a" if i % 2 else None, "n") for i, t in enumerate(TEXTS * 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")


def test_model(small):
    docs = small.withColumn("lang", F.coalesce("lang", F.lit("")))
    tables = rules.hash_arrays(rules.kneser_ney(rules.count_grams(docs)))
    for lang in ("", "a"):
        own = [r.text for r in docs.where(F.col("lang") == lang).collect()]
        p = plain_model(own)
        for text in [*own, "q", "a bq c"]:
            keys, _ = rules._grams([text])
            s = chr(2) * 3 + text + chr(3)
            wanted = [math.log(p(s[i:i + 4])) for i in range(len(s) - 3)]
            assert np.allclose(rules.log_probabilities(tables[lang], keys), wanted)


def test_both_ways_of_scoring(small):
    a, b = (sorted(map(tuple, rules.score(small, n).collect()), key=repr)
            for n in (rules.MODEL_ROWS, 10))
    assert a == b and len(a) == 20


def test_bands_reject_strange_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = F.when(F.col("doc_id") % 50 == 1, F.reverse("text")).otherwise(F.col("text"))
    out = rules.judge(docs.withColumn("text", text)).where("not base_failed").withColumn(
        "odd", F.col("doc_id") % 50 == 1)
    kept = {r.odd: r.share for r in out.groupBy("odd").agg(
        F.avg(F.col("kept").cast("double")).alias("share")).collect()}
    assert kept[False] > 0.9 and kept[True] < 0.1


def test_odd_rows(spark, small):
    rows = [(1, None, "en", 1), (None, "x", "en", 1), (2, "", None, 1), (3, "word " * 20_000, "en", 1),
            (3, "word " * 20_000, "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    out = rules.judge(df)
    assert out.count() == 5 and out.where("base_failed").count() == 5
    assert rules.filter_documents(df).columns == df.columns
    assert rules.judge(df.where("false")).count() == 0


def test_copies_set_neither_model_nor_band(spark):
    """One text as two thirds of a language: the others are judged as without its copies."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    few = docs.select("doc_id", "text", "lang").orderBy("doc_id").limit(150).cache()
    one = few.where(F.length("text") > 1500).orderBy("doc_id").limit(1)
    copies = one.crossJoin(spark.range(300).withColumnRenamed("id", "n")).select(
        (F.col("n") + 10_000_000).alias("doc_id"), "text", "lang")
    plain = {r.doc_id: r for r in rules.judge(few).collect()}
    out = {r.doc_id: r for r in rules.judge(few.unionByName(copies)).collect()}
    assert len(out) == len(few.collect()) + 300
    for i, r in plain.items():
        assert (out[i].kept, out[i].log_ppl, out[i].low, out[i].high) == (
            r.kept, r.log_ppl, r.low, r.high)
    passed = [r for r in plain.values() if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.8 * len(passed) > 40


@pytest.mark.parametrize("copied", [0, 100])
def test_distinct_texts(spark, copied):
    rows = [("a", "x"), ("a", "x"), ("b", "x"), ("a", "y"), ("a", None), ("a", ""), ("b", "z z")]
    out = rules.distinct_texts(spark.createDataFrame(rows, "lang string, text string"), copied)
    assert sorted(map(tuple, out.collect())) == [
        ("a", ""), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "z z")]


def test_null_language_is_its_own(spark):
    docs = spark.createDataFrame(
        [(1, "a b", None), (2, "c d", ""), (3, "e f", "="), (4, "g h", "en")],
        "doc_id long, text string, lang string")
    assert rules.score(docs).select("lang").distinct().count() == 4


def test_filter_goes_by_language(spark):
    """Equal rows of another language are judged by their own band."""
    rng = np.random.default_rng(8)

    def text(alphabet):
        return " ".join("".join(rng.choice(list(alphabet), size=5)) for _ in range(80))

    ours = [text("abcdefgh") for _ in range(40)]
    theirs = [text("stuvwxyz") for _ in range(40)]
    rows = [(i, t, "one") for i, t in enumerate(ours)]
    rows += [(100 + i, t, None) for i, t in enumerate(theirs)]
    rows += [(0, ours[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns
    judged = {(r.doc_id, r.lang): r.kept for r in rules.judge(docs).collect()}
    assert judged[0, "=one"] and not judged[0, ""]
    assert sorted((r.doc_id, r.lang is None) for r in kept.collect()) == sorted(
        (d, lang == "") for (d, lang), k in judged.items() if k)
