"""Hard-negative mining by BOND: branch and bound on vertically decomposed vectors.

Vectors become whole numbers and are stored by dimension: a block of rows is one array a dimension,
with that dimension's smallest and largest value. An anchor reads the dimensions in falling order of
its own magnitudes, some at a time. After each read the score so far, plus the least and the most
that the unread dimensions can still add (from the block's smallest and largest values), bounds the
score of every candidate; a bitmap keeps those whose bounds still reach what is sought. What is left
after the last dimension has its exact score.

Two passes: the nearest rows of the anchor's own label are its positives; each positive's score makes
a window, and the nearest rows of other labels inside the windows are its negatives. Rows stay where
they are. The anchors, a stated set of queries, visit them in bounded blocks, and a task keeps only
the best few of each anchor, so no list of candidates is shuffled.

Defined results: a row takes part if it has an id, a label and a vector of the most common length
(ties: the longest) without NULL or non-finite components, each small enough for inner products to be
longs; of rows that share an id the one of the smallest label, then vector, counts. An anchor without
positives, or without negatives in a window, has no rows for it. No rows give no rows; other columns
are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from worklens.llm.common import columns, saved, shared_folder

#: A component x counts as floor(SCALE * x); where the id is divisible by MOVED the label moves on.
SCALE, MOVED, LABELS = 256, 7, 10
EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: Percent of a positive's score that a negative's lies between, both included.
LOW, HIGH = 50, 95
#: Rows of a vertical block, rows of a task, and anchors that visit the rows at once.
BLOCK, TASK, ANCHORS = 4096, 65_536, 4096
#: Dimensions read between two looks at the bounds.
READ = 16

ROW = "vec_id long, label int, x array<long>"
FOUND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that take part, each id once."""
    rows = columns(vectors, vec_id="long", label="int", embedding="array<double>")
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine
                      & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    width = common["length"] if common else 1
    largest = float(int((2**62 / width) ** 0.5) // SCALE)  # sums of products stay within a long
    rows = rows.where((F.size("embedding") == F.lit(width))
                      & F.forall("embedding", lambda c: F.abs(c) < largest))
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(
        F.col("label"))
    rows = rows.select(
        "vec_id", F.struct(moved.cast("int").alias("label"), F.transform(
            "embedding", lambda c: F.floor(c * SCALE).cast("long")).alias("x")).alias("own"))
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism,
                -(-(common["count"] if common else 0) // TASK))
    # one shuffle: it deals the rows evenly and brings rows of one id together
    return rows.repartition(parts, "vec_id").groupBy("vec_id").agg(F.min("own").alias("own")).select(
        "vec_id", "own.label", "own.x")


class Block(NamedTuple):
    """Rows by dimension; ``low`` and ``high`` are each dimension's smallest and largest values."""

    ids: np.ndarray
    labels: np.ndarray
    dims: np.ndarray  # dimensions x rows
    low: np.ndarray
    high: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.int64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def vertical(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a block: ids, labels, and the values dimension by dimension."""
    schema = "ids array<long>, labels array<int>, dims array<long>, low array<long>, high array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                some = batch.slice(i, block)
                x = _matrix(some.column("x"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([some.column("label").to_pylist()], pa.list_(pa.int32())),
                     *(pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.ravel()))
                       for v in (np.ascontiguousarray(x.T), x.min(axis=0), x.max(axis=0)))],
                    names=["ids", "labels", "dims", "low", "high"])

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(block))
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 28))
    return rows.mapInArrow(run, schema)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, dims, low, high = (
                batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(5))
            yield Block(ids, labels, dims.reshape(len(low), -1), low, high)


def bounded_scores(query: np.ndarray, block: Block, alive: np.ndarray, wanted, read: int = READ):
    """(rows, exact scores) of the candidates that ``wanted`` keeps to the end.

    ``alive`` is the bitmap of candidates; ``wanted(rows, least, most)`` tells which candidates can
    still be sought, given bounds of their scores.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    q, low, high = query[order], block.low[order], block.high[order]
    one, other = q * low, q * high
    # what the dimensions from each place on can add at least and at most
    least = np.append(np.cumsum(np.minimum(one, other)[::-1])[::-1], 0)
    most = np.append(np.cumsum(np.maximum(one, other)[::-1])[::-1], 0)
    rows = np.flatnonzero(alive)
    score = np.zeros(len(rows), dtype=np.int64)
    exact = float(np.abs(q).max(initial=0)) * float(max(np.abs(low).max(), np.abs(high).max())) * (
        len(q)) < 2**53
    for i in range(0, len(q), read):
        if not len(rows):
            break
        values = block.dims[order[i:i + read]]
        values = values[:, rows] if len(rows) < values.shape[1] else values
        part = q[i:i + read]
        if exact:  # whole numbers below 2^53 are exact in double precision, and faster
            score = score + (part.astype(np.float64) @ values.astype(np.float64)).astype(np.int64)
        else:
            score = score + part @ values
        done = min(i + read, len(q))
        alive = wanted(rows, score + least[done], score + most[done])
        rows, score = rows[alive], score[alive]
    return rows, score


class Best:
    """The best few by (score falling, id) that a task has met so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def worst(self) -> int:
        """Scores below this are no longer sought."""
        return int(self.score[-1]) if len(self.score) == self.k else -2**63

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]


def kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -2**63


def near_positives(held: tuple, blocks: Iterator[Block], k: int = POSITIVES):
    """(anchor id, row id, score): the best of each anchor's label in these blocks."""
    ids, labels, points = held
    best = [Best(k) for _ in ids]
    for block in blocks:
        of_label = {label: block.labels == label for label in np.unique(labels)}
        for i, query in enumerate(points):
            def wanted(rows, least, most):
                # the k-th best lower bound, or the k-th best so far, is reached anyway
                return most >= max(kth_largest(least, k), best[i].worst())

            same = of_label[labels[i]] & (block.ids != ids[i])
            if same.any():
                rows, score = bounded_scores(query, block, same, wanted)
                best[i].add(score, block.ids[rows])
    for i, own in enumerate(best):
        yield np.full(len(own.ids), ids[i]), own.ids, own.score


def near_negatives(held: tuple, positives: tuple, blocks: Iterator[Block], k: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH):
    """(anchor id, positive id, row id, positive's score, score) of the best in each window."""
    ids, labels, points = held
    of, positive, goal = positives
    # windows in whole scores, by Python's own numbers: 100 * score may exceed a long
    floor = np.array([-(-low * int(p) // 100) for p in goal], dtype=np.int64)
    roof = np.array([high * int(p) // 100 for p in goal], dtype=np.int64)
    best = [Best(k) for _ in goal]
    windows = [[w for w in np.flatnonzero(of == a) if floor[w] <= roof[w]] for a in ids]
    for block in blocks:
        for i, query in enumerate(points):
            if not windows[i]:
                continue

            def wanted(rows, least, most):
                out = np.zeros(len(rows), dtype=bool)
                for w in windows[i]:
                    out |= (most >= max(int(floor[w]), best[w].worst())) & (least <= roof[w])
                return out

            rows, score = bounded_scores(
                query, block, (block.labels != labels[i]) & (block.ids != ids[i]), wanted)
            for w in windows[i]:
                inside = (score >= floor[w]) & (score <= roof[w])
                if inside.any():
                    best[w].add(score[inside], block.ids[rows[inside]])
    for w, own in enumerate(best):
        n = len(own.ids)
        yield np.full(n, of[w]), np.full(n, positive[w]), own.ids, np.full(n, goal[w]), own.score


def _ranked(found: DataFrame, k: int, score: str, *by: str, tie: str) -> DataFrame:
    rank = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def _visit(blocks: DataFrame, anchors: pa.Table) -> DataFrame:
    """Negatives of one block of anchors over all rows."""
    spark = blocks.sparkSession
    held = spark.sparkContext.broadcast((
        anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(),
        _matrix(anchors.column("x"))))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in near_positives(held.value, blocks_of(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in part],
                                             names=["anchor_id", "positive_id", "positive_score"])

    near = blocks.mapInArrow(first, "anchor_id long, positive_id long, positive_score long")
    # at most POSITIVES rows an anchor of this block
    own = _ranked(near, POSITIVES, "positive_score", "anchor_id", tie="positive_id").select(
        "anchor_id", "positive_id", "positive_score").toArrow()
    goals = spark.sparkContext.broadcast(tuple(
        own.column(c).to_numpy() for c in ("anchor_id", "positive_id", "positive_score")))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in near_negatives(held.value, goals.value, blocks_of(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in part],
                names=[c.split()[0] for c in FOUND.split(", ")])

    found = blocks.mapInArrow(second, FOUND)
    return _ranked(found, NEGATIVES, "negative_score", "anchor_id", "positive_id", tie="negative_id")


def mine(vectors: DataFrame, every: int = EVERY, anchors: int = ANCHORS, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides. They visit the rows ``anchors`` at a time; each
    visit's rows are written to the shared folder, so a visit that is done is never done again.
    """
    spark: SparkSession = vectors.sparkSession
    rows = whole(vectors)
    blocks = saved(vertical(rows, block))
    asked = rows.where(F.col("vec_id") % every == 0)
    # dealt by hash into visits of about equal size
    visits = max(1, -(-asked.count() // anchors))
    asked = saved(asked.withColumn("visit", F.pmod(F.xxhash64("vec_id"), F.lit(visits)).cast("int")))
    folder = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    for visit in range(visits):
        own = asked.where(F.col("visit") == visit).select("vec_id", "label", "x").toArrow()
        _visit(blocks, own).write.parquet(f"{folder}/visit={visit}")
    found = spark.read.schema(FOUND + ", rank int").parquet(*(
        f"{folder}/visit={visit}" for visit in range(visits)))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                        "negative_score")
