"""Counts equal the lengths of the encoder's lists, which equal the public library's."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from worklens.llm import sentences, token_counts


@pytest.fixture(scope="module")
def coder():
    return sentences.coder()


def lengths(coder, texts):
    return sentences.encode_texts(coder, [t.encode() for t in texts])[1].tolist()


def counts(coder, texts):
    return token_counts.count_tokens(coder, [t.encode() for t in texts])[0].tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abeht inäé.,\n\t0漢🙂 "), max_size=60),
                min_size=1, max_size=5))
def test_any_text(coder, texts):
    assert counts(coder, texts) == lengths(coder, texts)


def test_prefixes_are_shared(coder):
    found = sentences.segments(coder, [b"there the then theme"])
    trie = token_counts.prefix_trie(found)
    assert len(trie.byte) == 1 + len({w[:k] for w in (" there", " the", " then", " theme")
                                      for k in range(1, len(w) + 1)})


def test_whole_table(coder, spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {r.doc_id: r.n_tokens for r in token_counts.add_counts(df).collect()}
    rows = df.select("doc_id", "text").collect()
    assert [out[r.doc_id] for r in rows] == lengths(coder, [r.text for r in rows])


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "a", 7), (3, "a", 7), (4, "x" * 20_000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts.add_counts(df).orderBy("doc_id").collect()
    assert [r.n_tokens for r in out][:4] == [0, 0, 1, 1]
    assert [r.n_pretokens for r in out] == [0, 0, 1, 1, 1]
    assert token_counts.add_counts(df.where("false")).count() == 0
    ids, _ = sentences.encode_texts(sentences.coder(), [b"x" * 20_000])
    assert out[4].n_tokens == len(ids)
