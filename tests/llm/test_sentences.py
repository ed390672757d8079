"""Encoding against the public library's own unigram search under the same scores; round trips."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from worklens.llm import sentences
from worklens.llm.trie import NORMAL, vocabulary

TEXTS = ["", " ", "  x", "Hello  world\n a\tb 🙂 ", "Öffnung der Tür, élan\r\n\n", "aaaa" * 50,
         "日本語テキスト", "\x00\x01", " lead and trail ", "x" * 3000, "The and attion to thanedble"]


@pytest.fixture(scope="module")
def coder():
    return sentences.coder()


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores as a unigram model of the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    words = vocabulary(sentences.VOCABULARY)
    model = pb.ModelProto()
    with open(sentences.VOCABULARY, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for i, piece in enumerate(model.pieces):
        if words.kind[i] == NORMAL:
            piece.score = float(words.score[i])
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def encoded(coder, texts):
    ids, size = sentences.encode_texts(coder, [t.encode() for t in texts])
    return [list(x) for x in np.split(ids, np.cumsum(size)[:-1])]


def test_same_as_library(coder, library):
    assert encoded(coder, TEXTS) == [library.encode(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abeht inäé.,\n\t0漢🙂 "), max_size=60), max_size=5))
def test_any_text(coder, library, texts):
    if not texts:
        return
    ours = encoded(coder, texts)
    assert ours == [library.encode(t) for t in texts]
    sizes = np.array([len(x) for x in ours])
    flat = np.array([i for x in ours for i in x], dtype=np.int64)
    assert sentences.decode_ids(coder, flat, sizes) == [t.encode() for t in texts]


def test_real_texts(coder, library, spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    texts = [r.text for r in rows]
    assert encoded(coder, texts) == [library.encode(t) for t in texts]


def test_frame(spark):
    rows = [(i, t, "n") for i, t in enumerate([*TEXTS, None, "▁"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = {r.doc_id: r for r in sentences.decode(sentences.encode(df)).collect()}
    for i, text, _ in rows:
        assert out[i].text == text
        if text is None:
            assert out[i].ids is None and out[i].n_pieces is None and out[i].decoded is None
        elif text == "▁":
            assert out[i].decoded == " " and out[i].round_trip
        else:
            assert out[i].decoded == text and out[i].round_trip
            assert out[i].n_pieces == len(out[i].ids)
    assert sentences.encode(df.where("false")).count() == 0
