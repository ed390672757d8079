"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of scored pieces.

A text gets a space in front, spaces stand for the vocabulary's marks, and the segmentation of the
highest total log score wins (ties: the longest last piece). A character without a piece becomes its
UTF-8 byte pieces. Decoding joins the pieces' bytes and takes the first space away. Encoding then
decoding gives the text back, but for the mark character itself, which comes back as a space.

Defined results: NULL encodes to NULL, an empty text to an empty list; equal texts get equal lists;
other columns pass through; no rows give no rows. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from worklens.llm.common import bounded_batches, slices
from worklens.llm.spans import distinct_spans
from worklens.llm.trie import (
    BYTE, MARK, NORMAL, Vocabulary, best_paths, double_array, lattice, ragged, vocabulary,
)

#: Place of the public vocabulary.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


class Coder(NamedTuple):
    """What tasks need, as plain arrays: bounded by the vocabulary, not by the data."""

    trie: tuple
    score: np.ndarray  # one more: a character without a piece
    byte_id: np.ndarray
    alone: np.ndarray  # of the 256 bytes, those in no piece: each is a segment of its own
    text: np.ndarray  # bytes of all pieces, one after the other
    text_start: np.ndarray
    text_length: np.ndarray


def coder(path: str = VOCABULARY) -> Coder:
    return coder_of(vocabulary(path))


def coder_of(words: Vocabulary) -> Coder:
    normal = {t: i for i, t in enumerate(words.text) if words.kind[i] == NORMAL}
    if any(b" " in t.lstrip(b" ") for t in normal):
        raise ValueError("a piece has a space behind another character: words are not independent")
    alone = np.ones(256, dtype=bool)
    alone[0x80:] = False
    for t in normal:
        alone[np.frombuffer(t, dtype=np.uint8)] = False
    length = np.array([len(t) for t in words.text])
    unknown = words.score[words.kind == NORMAL].min() - 10.0
    return Coder(
        double_array(normal), np.append(words.score, unknown), words.byte_id, alone,
        np.frombuffer(b"".join(words.text), dtype=np.uint8),
        np.concatenate(([0], np.cumsum(length)[:-1])), length)


class Segments(NamedTuple):
    """The distinct segments of some texts in a buffer of their own, and where each text uses them."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    used: np.ndarray  # number of a distinct segment, text after text
    first: np.ndarray  # of each text the first of its uses; one more than texts


def segments(coder: Coder, texts: list[bytes]) -> Segments:
    """No piece crosses from one segment into another: leading spaces and what follows them."""
    marked = [b" " + t.replace(MARK.encode(), b" ") if t else b"" for t in texts]
    buf = np.frombuffer(b"\n".join(marked) + b"\n", dtype=np.uint8)
    text_start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in marked])))
    stop = text_start[1:] - 1  # the line feeds between the texts
    space, alone = buf == 0x20, coder.alone[buf]
    turn = alone.copy()
    turn[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
    turn[text_start[:-1]] = True
    turn[stop] = True
    start = np.flatnonzero(turn)
    end = np.append(start[1:], len(buf))
    inside = np.ones(len(start), dtype=bool)
    inside[np.searchsorted(start, stop)] = False
    start, end = start[inside], end[inside]
    first = np.searchsorted(start, text_start)
    at, used = distinct_spans(buf, start, end)
    length = end[at] - start[at]
    place = np.concatenate(([0], np.cumsum(length + 1)))
    own = np.zeros(int(place[-1]), dtype=np.uint8)
    own[ragged(place[:-1], length)] = buf[ragged(start[at], length)]
    return Segments(own, place[:-1], place[:-1] + length, used, first)


def encode_segments(coder: Coder, found: Segments) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the distinct segments, one after the other, and how many each has."""
    edges = lattice(coder.trie, found.buf, found.start, found.end)
    back = best_paths(edges, coder.score[edges.piece], len(found.buf) + 1)
    # from the ends backwards, all segments in step
    at, which, steps = found.end, np.arange(len(found.end)), []
    while len(which):
        edge = back[at]
        steps.append((which, edge))
        at = edges.frm[edge]
        more = at > found.start[which]
        at, which = at[more], which[more]
    if not steps:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    which = np.concatenate([w for w, _ in steps[::-1]])
    edge = np.concatenate([e for _, e in steps[::-1]])
    order = np.argsort(which, kind="stable")
    which, edge = which[order], edge[order]
    piece, frm = edges.piece[edge], edges.frm[edge]
    size = np.where(piece < 0, edges.to[edge] - frm, 1)
    ids = np.repeat(piece, size)
    lacking = np.repeat(piece < 0, size)
    ids[lacking] = coder.byte_id[found.buf[ragged(frm, size)[lacking]]]
    return ids, np.bincount(which, weights=size, minlength=len(found.start)).astype(np.int64)


def encode_texts(coder: Coder, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, one text after the other, and how many each has."""
    found = segments(coder, texts)
    ids, size = encode_segments(coder, found)
    begin = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
    sizes = size[found.used]
    total = np.concatenate(([0], np.cumsum(sizes)))
    return ids[ragged(begin[found.used], sizes)], np.diff(total[found.first])


def decode_ids(coder: Coder, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
    """The bytes of lists of ids, given one after the other."""
    length = coder.text_length[ids]
    joined = coder.text[ragged(coder.text_start[ids], length)].tobytes()
    bound = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(size)))]
    out = [joined[a:b] for a, b in zip(bound[:-1], bound[1:])]
    return [t[1:] if t[:1] == b" " else t for t in out]


def _int_lists(ids: np.ndarray, size: np.ndarray, null: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(ids.astype(np.int32)), mask=pa.array(null))


def encoder(spark: SparkSession, path: str = VOCABULARY):
    """A column function: text to ``struct<ids, n_byte_pieces, round_trip>``.

    ``round_trip`` decodes the ids and compares with the text. The trie is broadcast: its size is
    that of the vocabulary.
    """
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(tuple(coder(path)))

    @F.arrow_udf("struct<ids:array<int>,n_byte_pieces:long,round_trip:boolean>")
    def encode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Coder(*held.value)
        is_byte = np.zeros(len(own.text_length), dtype=bool)
        is_byte[own.byte_id] = True
        for texts in column:
            null = np.array(texts.is_null().to_numpy(zero_copy_only=False))
            data = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
            parts = []
            for a, b in slices(data):
                ids, size = encode_texts(own, data[a:b])
                back = decode_ids(own, ids, size)
                total = np.concatenate(([0], np.cumsum(is_byte[ids])))
                bound = np.concatenate(([0], np.cumsum(size)))
                mark = MARK.encode()
                same = [x == y.replace(mark, b" ") for x, y in zip(back, data[a:b])]
                parts.append(pa.StructArray.from_arrays(
                    [_int_lists(ids, size, null[a:b]),
                     pa.array(np.diff(total[bound]), mask=null[a:b]),
                     pa.array(np.array(same, dtype=bool), mask=null[a:b])],
                    names=["ids", "n_byte_pieces", "round_trip"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.struct(
                [("ids", pa.list_(pa.int32())), ("n_byte_pieces", pa.int64()),
                 ("round_trip", pa.bool_())]))

    return encode.asNondeterministic()  # not to be computed twice


def decoder(spark: SparkSession, path: str = VOCABULARY):
    """A column function: lists of ids to texts. Unknown ids raise; byte pieces that are no UTF-8
    become the replacement character; a list holding NULL is NULL."""
    held = spark.sparkContext.broadcast(tuple(coder(path)))

    @F.arrow_udf("string")
    def decode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Coder(*held.value)
        for lists in column:
            rows = [None if x is None or None in x else x for x in lists.to_pylist()]
            ids = np.array([i for x in rows if x for i in x], dtype=np.int64)
            size = np.array([len(x or ()) for x in rows], dtype=np.int64)
            texts = decode_ids(own, ids, size) if len(rows) else []
            yield pa.array([None if x is None else t.decode("utf-8", "replace")
                            for x, t in zip(rows, texts)], pa.string())

    return decode


def encode(docs: DataFrame, path: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (list of int), ``n_pieces``, ``n_byte_pieces`` and ``round_trip``.

    Columns of these names are replaced.
    """
    made = ("ids", "n_pieces", "n_byte_pieces", "round_trip")
    rest = docs.drop(*made)
    coded: Column = encoder(docs.sparkSession, path)(F.col(text).cast("string"))
    kept = [F.col(f"`{c}`") for c in rest.columns]
    return rest.select(*kept, coded.alias("_coded")).select(
        *kept, F.col("_coded.ids").alias("ids"),
        F.size("_coded.ids").cast("long").alias("n_pieces"),
        F.col("_coded.n_byte_pieces").alias("n_byte_pieces"),
        F.col("_coded.round_trip").alias("round_trip"))


def decode(docs: DataFrame, path: str = VOCABULARY, ids: str = "ids", text: str = "decoded"):
    """``docs`` with the texts of ``ids``."""
    return docs.withColumn(text, decoder(docs.sparkSession, path)(F.col(ids)))
