"""Token counts: dynamic programming over a trie of distinct pre-tokens.

The distinct pre-tokens of a slice of texts form a trie. The unigram forward score of a prefix is
computed once for all pre-tokens that share it, from the scores of its own prefixes and the pieces
between them; the token count of the best segmentation goes with it and is read off at the node
where a pre-token ends. Ties go to the longest last piece, as in :mod:`.sentences`.

Defined results: NULL and empty texts have 0 tokens and 0 pre-tokens; equal texts equal counts;
other columns pass through; no rows give no rows. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from worklens.llm.common import bounded_batches, slices
from worklens.llm.sentences import VOCABULARY, Coder, Segments, coder, segments
from worklens.llm.trie import Lattice, best_paths, char_bytes


class PrefixTrie(NamedTuple):
    """Nodes numbered level by level; the children of a node follow one another. Node 0: the root."""

    byte: np.ndarray  # that leads to each node
    first: np.ndarray  # child of each node
    children: np.ndarray  # how many
    depth: np.ndarray
    char_from: np.ndarray  # node before the last whole character, -1 within one
    end: np.ndarray  # node where each pre-token ends


def prefix_trie(found: Segments) -> PrefixTrie:
    length = found.end - found.start
    node = np.zeros(len(length), dtype=np.int64)
    active = np.flatnonzero(length > 0)
    byte, first, children = [np.zeros(1, np.uint8)], [], []
    char_from = [np.zeros(1, np.int64)]
    before, left = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of the last level's nodes
    base, total, depth = 0, 1, 0  # first node of the last level, all nodes
    while len(active):
        key = (node[active] << 8) | found.buf[found.start[active] + depth]
        distinct, place = np.unique(key, return_inverse=True)
        parent, code = distinct >> 8, (distinct & 0xFF).astype(np.uint8)
        below = np.bincount(parent - base, minlength=total - base)
        children.append(below)
        first.append(total + np.concatenate(([0], np.cumsum(below)[:-1])))
        opens = left[parent - base] == 0
        before = np.where(opens, parent, before[parent - base])
        left = np.where(opens, char_bytes(code), left[parent - base]) - 1
        byte.append(code)
        char_from.append(np.where(left == 0, before, -1))
        node[active] = total + place
        base, total, depth = total, total + len(distinct), depth + 1
        active = active[length[active] > depth]
    children.append(np.zeros(total - base, dtype=np.int64))
    first.append(np.zeros(total - base, dtype=np.int64))
    level = np.repeat(np.arange(len(byte)), [len(b) for b in byte])
    return PrefixTrie(np.concatenate(byte), np.concatenate(first), np.concatenate(children), level,
                      np.concatenate(char_from), node)


def piece_edges(pieces, trie: PrefixTrie) -> Lattice:
    """Each piece between a node and one below it, found by walking both tries at once."""
    base, check, value = pieces
    starts = trie.char_from >= 0
    starts[0] = True
    origin = node = np.flatnonzero(starts & (trie.children > 0))
    state = np.zeros(len(node), dtype=np.int32)
    found = []
    while len(node):
        fan = trie.children[node]
        before = np.concatenate(([0], np.cumsum(fan)[:-1]))
        below = np.repeat(trie.first[node] - before, fan) + np.arange(int(fan.sum()))
        origin, state = np.repeat(origin, fan), np.repeat(state, fan)
        onward = base[state] + trie.byte[below] + 1
        ok = check[onward] == state
        origin, node, state = origin[ok], below[ok], onward[ok]
        hit = value[state] >= 0
        found.append((origin[hit], node[hit], value[state[hit]]))
    frm, to, piece = (np.concatenate(x) for x in zip(*found)) if found else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
    whole = np.zeros(len(trie.byte), dtype=bool)
    whole[to[frm == trie.char_from[to]]] = True
    lacking = np.flatnonzero((trie.char_from >= 0) & ~whole)
    lacking = lacking[lacking > 0]
    frm = np.concatenate((frm, trie.char_from[lacking]))
    to = np.concatenate((to, lacking))
    piece = np.concatenate((piece, np.full(len(lacking), -1, dtype=np.int32)))
    order = np.lexsort((frm, to))  # levels are in the numbering; the longest piece starts first
    return Lattice(frm[order], to[order], piece[order], trie.depth[to[order]])


def count_tokens(own: Coder, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and pre-tokens of each text."""
    found = segments(own, texts)
    trie = prefix_trie(found)
    edges = piece_edges(own.trie, trie)
    back = best_paths(edges, own.score[edges.piece], len(trie.byte))
    units = np.where(edges.piece < 0, trie.depth[edges.to] - trie.depth[edges.frm], 1)
    tokens = np.zeros(len(trie.byte), dtype=np.int64)
    bound = np.searchsorted(trie.depth, np.arange(1, int(trie.depth[-1]) + 2))
    for a, b in zip(bound[:-1], bound[1:]):  # counts go down the tree, level by level
        edge = back[a:b]
        reached = edge >= 0
        tokens[a:b][reached] = tokens[edges.frm[edge[reached]]] + units[edge[reached]]
    total = np.concatenate(([0], np.cumsum(tokens[trie.end][found.used])))
    return np.diff(total[found.first]), np.diff(found.first)


def counter(spark: SparkSession, path: str = VOCABULARY):
    """A column function: text to ``struct<n_tokens, n_pretokens>``."""
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(tuple(coder(path)))

    @F.arrow_udf("struct<n_tokens:long,n_pretokens:long>")
    def count(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Coder(*held.value)
        for texts in column:
            data = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
            parts = [count_tokens(own, data[a:b]) for a, b in slices(data)]
            both = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
                    for k in range(2)]
            yield pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int64)) for x in both], names=["n_tokens", "n_pretokens"])

    return count.asNondeterministic()  # not to be computed twice


def add_counts(docs: DataFrame, path: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``n_pretokens``; columns of these names are replaced."""
    rest = docs.drop("n_tokens", "n_pretokens")
    kept = [F.col(f"`{c}`") for c in rest.columns]
    counted = counter(docs.sparkSession, path)(F.col(text).cast("string"))
    return rest.select(*kept, counted.alias("_counted")).select(
        *kept, F.col("_counted.n_tokens").alias("n_tokens"),
        F.col("_counted.n_pretokens").alias("n_pretokens"))
