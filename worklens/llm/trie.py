"""Pieces of a public vocabulary in a double-array trie, and dynamic programs over many words.

A lattice is a set of edges ``frm -> to`` between positions; all edges that end at one level are
handled at once, so the Python steps are as many as the longest word has bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces
MARK = "▁"  # fixed value: stands for a space in the vocabulary's files


class Vocabulary(NamedTuple):
    """``text`` of each id with spaces for marks, ``kind`` of each id, log ``score`` of each id."""

    text: list[bytes]
    kind: np.ndarray
    score: np.ndarray
    byte_id: np.ndarray  # id of each of the 256 byte pieces


def vocabulary(path: str) -> Vocabulary:
    """Read a public vocabulary file; the file is read on the driver, wherever it lies.

    The file ranks its pieces but has no probabilities; the log scores follow the Zipf-Mandelbrot
    law of the rank. They are whole multiples of 1/256, so sums do not depend on their order.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    kind = np.full(size, NORMAL)
    for i in range(size):
        if model.is_byte(i):
            kind[i] = BYTE
        elif model.is_unknown(i):
            kind[i] = UNKNOWN
        elif model.is_control(i) or model.is_unused(i):
            kind[i] = CONTROL
    pieces = [model.id_to_piece(i) for i in range(size)]
    weight = 1.0 / (np.cumsum(kind == NORMAL) + 2.7)
    score = np.round(256 * np.log(weight / weight[kind == NORMAL].sum())) / 256
    score[kind != NORMAL] = score[kind == NORMAL].min() - 10.0
    byte_id = np.zeros(256, dtype=np.int32)
    text = []
    for i, piece in enumerate(pieces):
        if kind[i] == BYTE:
            text.append(bytes([int(piece[3:5], 16)]))
            byte_id[text[i][0]] = i
        else:
            text.append(piece.replace(MARK, " ").encode() if kind[i] == NORMAL else b"")
    return Vocabulary(text, kind, score, byte_id)


def double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): from state s, byte c leads to t = base[s] + c + 1 if check[t] = s.

    ``value`` is the piece that ends in a state, or -1.
    """
    ordered = sorted(pieces)
    size = 4 * sum(map(len, ordered)) + 4096
    base, check = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
    value = np.full(size, -1, dtype=np.int32)
    check[0] = 0
    free, waiting = 1, [(0, 0, len(ordered), 0)]
    while waiting:
        state, lo, hi, depth = waiting.pop()
        if lo < hi and len(ordered[lo]) == depth:
            value[state] = pieces[ordered[lo]]
            lo += 1
        children, i = [], lo
        while i < hi:
            j, byte = i, ordered[i][depth]
            while j < hi and ordered[j][depth] == byte:
                j += 1
            children.append((byte + 1, i, j))
            i = j
        if not children:
            continue
        codes = np.array([c for c, _, _ in children])
        window, at = free, 0
        while not at:
            slots = window + np.flatnonzero(check[window:window + 512] < 0)
            if len(slots) < 25 and window == free:
                free += 512  # nearly full: leave it
            slots = slots[slots > codes[0]] - codes[0]
            if len(codes) > 1 and len(slots):
                slots = slots[(check[slots[:, None] + codes[None, 1:]] < 0).all(axis=1)]
            if len(slots):
                at = int(slots[0])
            window += 512
        base[state] = at
        for c, i, j in children:
            check[at + c] = state
            waiting.append((at + c, i, j, depth + 1))
    used = int(np.flatnonzero(check >= 0).max()) + 258
    return base[:used], check[:used], value[:used]


class Lattice(NamedTuple):
    """Edges sorted by level, then by end, longest first. ``piece`` -1: a character without one."""

    frm: np.ndarray
    to: np.ndarray
    piece: np.ndarray
    level: np.ndarray


def _sorted(frm, to, piece, level, length) -> Lattice:
    order = np.lexsort((to.astype(np.int64) * 64 + (63 - length), level))
    return Lattice(frm[order], to[order], piece[order], level[order])


def char_bytes(lead: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts with each byte."""
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


def lattice(trie, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lattice:
    """Every piece within every word ``buf[start:end]``; words must not touch."""
    base, check, value = trie
    length = end - start
    at = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(
        length.sum())
    stop, word = np.repeat(end, length), np.repeat(start, length)
    lead = (buf[at] & 0xC0) != 0x80
    at, stop, word = at[lead], stop[lead], word[lead]
    char_end = at + char_bytes(buf[at])
    whole = np.zeros(len(at), dtype=bool)
    origin, pos, state = np.arange(len(at)), at.copy(), np.zeros(len(at), dtype=np.int32)
    found = []
    while len(origin):
        onward = base[state] + buf[pos] + 1
        ok = check[onward] == state
        origin, pos, state = origin[ok], pos[ok] + 1, onward[ok]
        hit = value[state] >= 0
        by = origin[hit]
        found.append((by, pos[hit], value[state[hit]]))
        whole[by[pos[hit] == char_end[by]]] = True
        more = pos < stop[origin]
        origin, pos, state = origin[more], pos[more], state[more]
    lacking = np.flatnonzero(~whole)
    found.append((lacking, char_end[lacking], np.full(len(lacking), -1)))
    by, to, piece = (np.concatenate(x) for x in zip(*found))
    return _sorted(at[by], to, piece.astype(np.int32), to - word[by], to - at[by])


def _levels(edges: Lattice):
    """For each level the range of its edges, and the first edge of each end in it."""
    new_end = np.flatnonzero(np.concatenate(([True], edges.to[1:] != edges.to[:-1])))
    bound = np.searchsorted(edges.level, np.arange(1, edges.level[-1] + 2))
    cut = np.searchsorted(new_end, bound)
    for a, b, i, j in zip(bound[:-1], bound[1:], cut[:-1], cut[1:]):
        if a < b:
            yield a, b, new_end[i:j] - a


def best_paths(edges: Lattice, weight: np.ndarray, positions: int) -> np.ndarray:
    """The edge by which the best path reaches each position (-1: none); ties to the longest."""
    best, back = np.zeros(positions), np.full(positions, -1)
    if not len(edges.to):
        return back
    for a, b, first in _levels(edges):
        reached = best[edges.frm[a:b]] + weight[a:b]
        top = np.maximum.reduceat(reached, first)
        of_end = np.repeat(top, np.diff(np.append(first, b - a)))
        chosen = np.flatnonzero(reached == of_end)[::-1] + a  # the first of equals is written last
        back[edges.to[chosen]] = chosen
        best[edges.to[a:b][first]] = top
    return back


def forward(edges: Lattice, weight: np.ndarray, positions: int) -> np.ndarray:
    """Log of the summed weights of all paths to each position; ``weight`` may have columns."""
    total = np.zeros((positions, *weight.shape[1:]))
    if len(edges.to):
        for a, b, first in _levels(edges):
            reached = total[edges.frm[a:b]] + weight[a:b]
            total[edges.to[a:b][first]] = np.logaddexp.reduceat(reached, first, axis=0)
    return total


def piece_weights(edges: Lattice, buf: np.ndarray, score: np.ndarray, byte_id: np.ndarray):
    """Log weight of each edge; a character without a piece costs all its byte pieces."""
    weight = score[edges.piece]
    lacking = np.flatnonzero(edges.piece < 0)
    if len(lacking):
        weight[lacking] = 0
        for k in range(4):
            have = lacking[edges.frm[lacking] + k < edges.to[lacking]]
            weight[have] += score[byte_id[buf[edges.frm[have] + k]]]
    return weight


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one after the other."""
    before = np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))
