"""The stages one after the other against plain decisions on a small table."""

from pyspark.sql import functions as F

import corpus_pipeline
from worklens.llm import langid, rules

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        after = stage(spark, docs, SF).cache()
        found[name] = after
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= before
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == names
        if name == "language ID":
            kept = langid.identify(docs).where("lang_pred != 'und' and score >= 0.5")
            assert ids == {r.doc_id for r in kept.collect()}
        if name == "quality rules":
            assert ids == {r.doc_id for r in rules.judge(docs).where("kept").collect()}
        docs = after
    assert docs.where("not round_trip").count() == 0
    assert found["SimHash near-dedup"].groupBy("doc_id").count().where("count > 1").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0
    assert out.where("ids is null or size(ids) != n_pieces").count() == 0
    assert out.agg(F.countDistinct("doc_id")).first()[0] < 200
