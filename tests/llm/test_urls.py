"""Rules against plain string code; trees against the labels of URLs they were not fitted on."""

import re

import pytest
from pyspark.sql import functions as F

from worklens.llm import urls


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in urls.RULES if (host == r.rule.split("/")[0]
            or host.endswith("." + r.rule.split("/")[0]))
            and path.startswith(r.rule[r.rule.index("/"):])]
    best = max(fits, key=lambda r: len(r.rule), default=None)
    return host, path, best and best.rule, best and best.verdict


ODD = ["http://Example.COM/en/x?y://z", "https://www.example.com/en/", "http://example.com", "ftp://net/es/a",
       "http://a.net/fr/", "http://xnet/fr/", "http://a.net/FR/", "no scheme", "", "://", "x://y://z/en/",
       "http://ÄB.com/é\n/b#f", "http://com/", "http://u@b.com:80?x=/en/", "http://a.com/en/\n?q", None]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.1/pages.parquet")


@pytest.fixture(scope="module")
def judged(pages):
    return urls.judge(pages, urls.labelled_by_host(pages)).cache()


def test_rules(spark, pages, judged):
    odd = spark.createDataFrame([(i, u, "h") for i, u in enumerate(ODD)],
                                "page_id long, url string, host string")
    for out in (judged.collect(), urls.judge(odd, urls.labelled_by_host(pages)).collect()):
        for r in out:
            host, path, rule, verdict = plain(r.url)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict in ("allow", "block") and verdict in (None, r.verdict)


def test_held_out_labels(pages):
    labelled = urls.labelled_by_host(pages).withColumn("fold", F.xxhash64("url", F.lit(1)) % 3 == 0)
    out = urls.judge(labelled.where("fold"), labelled.where("not fold"), rules=(urls.Rule("allow", "none/"),))
    hit, false, bad = out.agg(
        F.avg(F.when(F.col("label") == 1, (F.col("verdict") == "block").cast("double"))),
        F.avg(F.when(F.col("label") == 0, (F.col("verdict") == "block").cast("double"))),
        F.sum("label")).first()
    assert bad > 20 and hit > 0.9 and false < 0.05


def test_no_python_on_the_executors(judged, pages):
    plan = urls.judge(pages, urls.labelled_by_host(pages))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edges(spark):
    df = spark.createDataFrame([(1, "http://a.org/" + "x" * 100_000), (1, "http://b.org/"), (2, None)],
                               "page_id long, url string")
    out = urls.judge(df, urls.labelled_by_host(df))
    assert {r.verdict for r in out.collect()} == {"allow"}
    assert urls.judge(df.where("false"), urls.labelled_by_host(df)).count() == 0
    nothing = urls.judge(df, urls.labelled_by_host(df.where("false")))
    assert nothing.count() == 3


def test_hosts_of_unseen_suffixes(spark):
    """Every suffix has one host: what tells hosts apart is their text, not their own label."""
    rows = [(f"http://{'a-b-' if i % 4 == 0 or i % 40 == 1 else 'abcd'}.s{i:04d}.org/p{i}",
             float(i % 4 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "url string, label double")
    new = df.where("substring_index(url, 'p', -1) % 3 = 0")
    out = urls.judge(new, df.exceptAll(new), rules=(urls.Rule("allow", "none/"),)).collect()
    hit, false = ([r.verdict == "block" for r in out if r.label == x] for x in (1, 0))
    assert sum(hit) > 0.9 * len(hit) > 40 and sum(false) < 0.1 * len(false)
    assert urls.train(df, 50)[1].agg(F.count("suffix"), F.sum("seen")).first() == (600, 600)


def test_copies_do_not_fill_the_sample(spark):
    """A URL with over half of the rows and the smallest hash is one URL of the sample."""
    rows = [(f"http://{'a-b' if i % 4 == 0 else 'ab'}.s{i % 9}.org/p{i}", float(i % 4 == 0))
            for i in range(300)]
    df = spark.createDataFrame(rows, "url string, label double")
    least = df.orderBy(F.pmod(F.xxhash64("url"), F.lit(1 << 40))).limit(1)
    model, suffixes, base = urls.train(df.unionByName(least.crossJoin(spark.range(400)).drop("id")), 100)
    assert model.featureImportances.numNonzeros() > 0
    assert (base, suffixes.agg(F.sum("seen")).first()[0]) == (0.25, 300)
