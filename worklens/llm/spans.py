"""Words of many texts at once, as numpy arrays over one buffer."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: fixed values: the white space of every contract, \x20 and \x09-\x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Added to each 8-byte word of a span by its place before it is mixed.
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """``buf`` holds the texts, each followed by a line feed, so no word crosses two texts."""

    buf: np.ndarray
    text_start: np.ndarray  # one more than texts
    start: np.ndarray  # of each word
    end: np.ndarray
    first: np.ndarray  # of each text the number of its first word; one more than texts


def words_of(texts: list[bytes]) -> Words:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    text_start = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=text_start[1:])
    space = SPACE[buf]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        turn = np.concatenate(([0], turn))
    start, end = turn[0::2], turn[1::2]
    return Words(buf, text_start, start, end, np.searchsorted(start, text_start))


def mix(x: np.ndarray) -> np.ndarray:
    """Finishes a 64-bit hash (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


class Lanes(NamedTuple):
    """Spans as 8-byte words, the last one of a span filled up with zeros."""

    word: np.ndarray  # span after span
    first: np.ndarray  # of each span; one more than spans


def lanes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lanes:
    n = (end - start + 7) >> 3
    first = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=first[1:])
    within = np.arange(int(first[-1])) - np.repeat(first[:-1], n)
    padded = np.concatenate((buf, np.zeros(8, dtype=np.uint8)))
    every = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    word = every[np.repeat(start, n) + 8 * within]
    left = np.repeat(end - start, n) - 8 * within  # bytes of the span from this word on
    short = np.flatnonzero(left < 8)
    word[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
    return Lanes(word, first)


def hash_lanes(spans: Lanes, length: np.ndarray) -> np.ndarray:
    n = np.diff(spans.first)
    within = np.arange(len(spans.word)) - np.repeat(spans.first[:-1], n)
    # each word is mixed with its place before it is added, so no sum of powers can cancel out
    mixed = mix(mix(spans.word ^ (within.astype(np.uint64) + np.uint64(1)) * _STEP) + _STEP)
    total = np.zeros(len(mixed) + 1, dtype=np.uint64)
    np.cumsum(mixed, out=total[1:])
    return mix(total[spans.first[1:]] - total[spans.first[:-1]] + length.astype(np.uint64) * _STEP)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: equal spans, equal hashes, wherever they stand."""
    return hash_lanes(lanes(buf, start, end), end - start)


def distinct_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(first span of each distinct one, number of its distinct one for each span).

    Spans of equal hashes are compared byte by byte; two that differ stay two.
    """
    own, length = lanes(buf, start, end), end - start
    _, at, used = np.unique(hash_lanes(own, length), return_index=True, return_inverse=True)
    n = np.diff(own.first)
    other = at[used]
    same = length == length[other]
    if same.all():
        base = np.repeat(own.first[other] - own.first[:-1], n)
        unequal = own.word != own.word[np.arange(len(own.word)) + base]
        same = np.diff(np.concatenate(([0], np.cumsum(unequal)))[own.first]) == 0
    if same.all():
        return at, used
    place: dict[bytes, int] = {}
    used = np.array([place.setdefault(buf[a:b].tobytes(), len(place))
                     for a, b in zip(start.tolist(), end.tolist())], dtype=np.int64)
    return np.unique(used, return_index=True)[1], used


def windows(number: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of every window of ``size`` numbers inside one text; equal key, equal window of
    the same text. Keys are packed, not hashed, so no two windows share one."""
    at = np.flatnonzero(text[size - 1:] == text[:len(text) - size + 1]) if len(text) >= size else (
        np.zeros(0, dtype=np.int64))
    key, most = text[at].astype(np.uint64), int(text[-1]) + 1 if len(text) else 1
    width = int(number.max()) + 1 if len(number) else 1
    for k in range(size):
        if most * width >= 1 << 64:  # too wide for one word: number the keys so far anew
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            most = int(key.max()) + 1 if len(key) else 1
        key = key * np.uint64(width) + number[at + k].astype(np.uint64)
        most *= width
    return at, key


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between successive ``bounds``; empty ranges give 0."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype != np.float64 else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
