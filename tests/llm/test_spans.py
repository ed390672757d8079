"""Spans told apart by their bytes: words built so that sums of powers cancel, windows, lanes."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from worklens.llm import rules, sentences, spans, token_counts


def cancelling(size: int) -> tuple[bytes, bytes]:
    """Two words whose polynomial hash modulo 2^64 is the same for any odd base."""
    a, b = b"a", b"b"
    while len(a) < size:
        a, b = a + b, b + a
    return a, b


def buffer(parts):
    start = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1])).astype(np.int64)
    return (np.frombuffer(b"".join(parts) + b"\n", dtype=np.uint8), start,
            start + np.array([len(p) for p in parts]))


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_cancelling_words(size):
    a, b = cancelling(size)
    hashes = spans.span_hashes(*buffer([a, b, a]))
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
    coder = sentences.coder()
    ids, n = sentences.encode_texts(coder, [a, b, b + b" " + a])
    assert sentences.decode_ids(coder, ids, n) == [a, b, b + b" " + a]
    counts = rules.base_counts([a + b"\n" + b, a + b"\n" + a])
    assert counts["n_dup_lines"].tolist() == [0, 1]
    words = rules.base_counts([b" ".join([a, b"x", b"y", b, b"x", b"y"]), b" ".join([a, b"x", b"y"] * 2)])
    assert words["n_repeat_words"].tolist() == [0, 6]
    tokens, _ = token_counts.count_tokens(coder, [a, b])
    assert tokens.tolist() == n[:2].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=20))
def test_distinct_spans(parts):
    first, used = spans.distinct_spans(*buffer(parts))
    assert len(first) == len(set(parts))
    assert [parts[first[u]] for u in used] == parts


def test_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(spans, "hash_lanes", lambda own, length: np.zeros(len(length), np.uint64))
    parts = [b"one", b"two", b"one", b"", b"a longer one than these", b"two"]
    first, used = spans.distinct_spans(*buffer(parts))
    assert [parts[first[u]] for u in used] == parts and len(first) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=8), min_size=1, max_size=6), st.booleans())
def test_windows(texts, wide):
    number = np.array([x * (2**40 if wide else 1) for t in texts for x in t], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    at, key = spans.windows(number, text, 3)
    plain = [(text[i], tuple(number[i:i + 3])) for i in range(len(number) - 2)
             if text[i] == text[i + 2]]
    assert len(at) == len(plain)
    assert len({(k, p) for k, p in zip(key.tolist(), plain)}) == len(set(plain)) == len(set(key.tolist()))
