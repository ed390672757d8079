"""Approximate nearest neighbours: an inverted multi-index over two halves of the vectors.

Each half has its own centroids; a vector lies in the cell of its two nearest ones. A query visits
cells in order of the summed distances of its halves to the two centroids, by a heap over centroid
pairs, until the cells visited hold enough vectors, whose true distances then decide.

How many are enough is measured, not guessed: some queries are compared with every row, and the
number is set so that ``RECALL`` of their true neighbours lie in the cells visited. The centroids
are fitted on a bounded sample; every vector is indexed.

Work is dealt in shards of cells. A cell of many vectors (copies of one, say) spreads over several
shards. Queries that lie near each other make a block, and a shard goes only to the blocks that ask for
it: one copy for up to ``QUERIES`` queries. A query goes to each of its shards with a bit for each of the
shard's cells. A shard keeps the nearest few of each query, so no list of candidates is shuffled.

Defined results: a vector that is NULL, zero, holds NULL or non-finite components, has no vec_id or
not the most common length (ties: the longest) takes no part; equal rows count once; ties go to the
smaller vec_id; a query with fewer candidates gets all of them if its cells hold them; no rows give
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from worklens.llm.common import columns, hash_sample, saved

#: Centroids of a half at most; fewer for few vectors. Cells are their pairs.
CENTROIDS = 128
#: Vectors that the centroids are fitted on, those of the smallest hash; and rounds of fitting.
SAMPLE, FITTING = 20_000, 12
#: Queries compared with every row, and the share of their neighbours that must be found.
MEASURED, RECALL = 64, 0.96
#: Vectors of a shard, and queries that meet a shard in one task, at most about twice as many.
SHARD, QUERIES = 16_384, 8192
#: Queries whose cells are looked up in one task.
LOOKED_UP = 256


class Index(NamedTuple):
    """Centroids of both halves, and for every cell its number of vectors."""

    left: np.ndarray
    right: np.ndarray
    count: np.ndarray


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, each once."""
    rows = columns(vectors, vec_id="long", embedding="array<double>").withColumnRenamed("embedding", "v")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & fine & F.exists("v", lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("v").alias("length")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("v") == F.lit(common["length"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances by the expanded form: for ranking cells, not for results."""
    return ((points ** 2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(1))


def fit(points: np.ndarray, k: int, rounds: int = FITTING) -> np.ndarray:
    """Centroids of the points by Lloyd's rounds; an empty one stays where it is."""
    rng = np.random.default_rng(4)
    centroids = points[rng.choice(len(points), size=min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([squared(points[i:i + 4096], centroids).argmin(1)
                              for i in range(0, len(points), 4096)])
        n = np.bincount(own, minlength=len(centroids))
        for d in range(points.shape[1]):
            total = np.bincount(own, weights=points[:, d], minlength=len(centroids))
            centroids[n > 0, d] = total[n > 0] / n[n > 0]
    return centroids


def cells_of(points: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    half = left.shape[1]
    return (squared(points[:, :half], left).argmin(1) * len(right)
            + squared(points[:, half:], right).argmin(1))


def visited(query: np.ndarray, index: Index, enough: int) -> list[int]:
    """Cells in order of summed distance until they hold ``enough`` vectors (or all are visited)."""
    half = index.left.shape[1]
    a = squared(query[None, :half], index.left)[0]
    b = squared(query[None, half:], index.right)[0]
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    a, b = a[by_a].tolist(), b[by_b].tolist()
    count, width = index.count, len(b)
    # a pair enters the heap from the pair before it in its row; rows open one after the other
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_a[i]) * width + int(by_b[j])
        if count[cell]:
            out.append(cell)
            held += int(count[cell])
        if j + 1 < width:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def cell_bits(cells: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """The shards in ``to``, and for each of them its lowest cell and a bit for each cell from there on."""
    order = np.lexsort((cells, to))
    shards, at = np.unique(to[order], return_index=True)
    bits = []
    for some in np.split(cells[order], at[1:]) if len(shards) else []:
        flags = np.zeros(int(some[-1] - some[0]) + 1, dtype=np.uint8)
        flags[some - some[0]] = 1
        bits.append((int(some[0]), np.packbits(flags).tobytes()))
    return shards, bits


def has_bit(cells: np.ndarray, lowest: int, bits: bytes) -> np.ndarray:
    """Which of the cells are among those of :func:`cell_bits`."""
    flags = np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).astype(bool)
    at = cells - lowest
    inside = (at >= 0) & (at < len(flags))
    inside[inside] = flags[at[inside]]
    return inside


def nearest(query: np.ndarray, points: np.ndarray, ids: np.ndarray, own_id: int, k: int):
    """(ids, distances) of the k nearest rows by the contract's measure, the query's own left out."""
    distance = np.sqrt(((points - query) ** 2).sum(axis=1))
    others = ids != own_id
    distance, ids = distance[others], ids[others]
    if len(ids) > 4 * k:
        limit = np.partition(distance, k - 1)[k - 1]
        near = distance <= limit
        distance, ids = distance[near], ids[near]
    order = np.lexsort((ids, distance))[:k]
    return ids[order], distance[order]


def build(rows: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> tuple[DataFrame, Index]:
    """(vec_id, v, cell) of every vector, and the index; ``rows`` is saved and not empty."""
    spark = rows.sparkSession
    some = hash_sample(rows, sample, "vec_id").select("v").toArrow()
    points = _matrix(some.column("v"))
    half = max(1, points.shape[1] // 2)
    k = max(1, min(centroids, int(np.sqrt(len(points))) * 2))
    left = fit(points[:, :half], k)
    right = fit(points[:, half:], k) if points.shape[1] > half else np.zeros((1, 0))
    held = spark.sparkContext.broadcast((left, right))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = cells_of(_matrix(batch.column("v")), *held.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int64))],
                                                 names=["vec_id", "v", "cell"])

    indexed = saved(rows.mapInArrow(assign, "vec_id long, v array<double>, cell long"))
    counts = indexed.groupBy("cell").count().toArrow()  # no more rows than cells
    count = np.zeros(len(left) * len(right), dtype=np.int64)
    count[counts.column("cell").to_numpy()] = counts.column("count").to_numpy()
    return indexed, Index(left, right, count)


def enough_for(indexed: DataFrame, index: Index, queries: DataFrame, k: int, recall: float = RECALL,
               measured: int = MEASURED) -> int:
    """Vectors that a query's cells must hold for ``recall``, measured against every row.

    A bounded number of queries goes to every task; each task returns its nearest few of them.
    """
    spark = indexed.sparkSession
    some = hash_sample(queries, measured, "vec_id").toArrow()
    if not some.num_rows:
        return 0
    ids, points = some.column("vec_id").to_numpy(), _matrix(some.column("v"))
    held = spark.sparkContext.broadcast((ids, points))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, of = _matrix(batch.column("v")), batch.column("vec_id").to_numpy()
            cell = dict(zip(of.tolist(), batch.column("cell").to_pylist()))
            for q, point in zip(*held.value):
                near, distance = nearest(point, own, of, q, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(near), pa.int64()), pa.array(near), pa.array(distance),
                     pa.array([cell[x] for x in near.tolist()], pa.int64())],
                    names=["q", "vec_id", "score", "cell"])

    rank = Window.partitionBy("q").orderBy("score", "vec_id")
    found = indexed.mapInArrow(scan, "q long, vec_id long, score double, cell long").withColumn(
        "rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("q", "cell").toArrow()
    at = {int(q): i for i, q in enumerate(ids)}
    needed = []
    wanted: dict[int, list[int]] = {}
    for q, cell in zip(found.column("q").to_pylist(), found.column("cell").to_pylist()):
        wanted.setdefault(q, []).append(cell)
    for q, cells in wanted.items():
        order = visited(points[at[q]], index, int(index.count.sum()))
        held_before = dict(zip(order, np.cumsum(index.count[order]) - index.count[order] + 1))
        needed += [held_before[c] for c in cells]
    return int(np.quantile(needed, recall, method="higher")) if needed else 0


def search(vectors: DataFrame, every: int = 100, k: int = 10, enough: int | None = None,
           centroids: int = CENTROIDS, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id ``every`` divides."""
    spark = vectors.sparkSession
    rows = saved(valid(vectors))
    empty = "query_id long, rank int, vec_id long, score double"
    if not rows.limit(1).count():
        return spark.createDataFrame([], empty)
    indexed, index = build(rows, centroids)
    own = indexed.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    if enough is None:
        enough = enough_for(indexed, index, own, k)
    enough = max(enough, 4 * k)
    # cells in order make shards of about equal size; a large cell has shards of its own
    first = np.concatenate(([0], np.cumsum(index.count)[:-1])) // shard
    parts = np.maximum(1, -(-index.count // shard))
    held = spark.sparkContext.broadcast((tuple(index), first, parts, enough))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first, parts, _ = held.value
        for batch in batches:
            cell, of = batch.column("cell").to_numpy(), batch.column("hash").to_numpy()
            to = first[cell] + of % parts[cell]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("cell"), pa.array(to)],
                names=["vec_id", "v", "cell", "shard"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, first, parts, enough = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("v"))
            for i, point in enumerate(points):
                cells = np.array(visited(point, Index(*index), enough), dtype=np.int64)
                n = parts[cells]
                to = np.repeat(first[cells] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(
                    int(n.sum()))
                shards, bits = cell_bits(np.repeat(cells, n), to)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("vec_id")[i].as_py()] * len(shards), pa.int64()),
                     pa.array([point.tolist()] * len(shards), pa.list_(pa.float64())),
                     pa.array([batch.column("block")[i].as_py()] * len(shards), pa.int32()),
                     pa.array([b for b, _ in bits], pa.int64()),
                     pa.array([b for _, b in bits], pa.binary()), pa.array(shards)],
                    names=["query_id", "q", "block", "lowest", "cells", "shard"])

    # queries in order of their cells make blocks of about equal size; a cell of many has its own
    asking = own.groupBy("cell").count().toArrow()  # no more rows than cells
    at, n = asking.column("cell").to_numpy(), asking.column("count").to_numpy()
    wanted = np.zeros(len(index.count), dtype=np.int64)
    wanted[at] = n
    near = spark.sparkContext.broadcast(
        ((np.cumsum(wanted) - wanted) // block, np.maximum(1, -(-wanted // block))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, parts = near.value
        for batch in batches:
            cell, of = batch.column("cell").to_numpy(), batch.column("hash").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"),
                 pa.array((begin[cell] + of % parts[cell]).astype(np.int32))],
                names=["vec_id", "v", "block"])

    by_hash = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    entries = indexed.withColumn("hash", by_hash).mapInArrow(
        deal, "vec_id long, v array<double>, cell long, shard long")
    tasks = max(1, -(-int(n.sum()) // LOOKED_UP))
    asked = own.withColumn("hash", by_hash).mapInArrow(
        place, "vec_id long, v array<double>, block int").repartition(tasks, "vec_id").mapInArrow(
        visit, "query_id long, q array<double>, block int, lowest long, cells binary, shard long")
    if int(n.sum()) > block:
        asked = saved(asked)
        pairs = asked.select(F.col("shard").alias("s"), F.col("block").alias("b")).distinct()
        entries = entries.join(pairs, F.col("shard") == F.col("s")).select(
            "vec_id", "v", "cell", "shard", F.col("b").alias("block"))
    else:  # a single block
        entries = entries.withColumn("block", F.lit(0))

    def meet(ours, theirs):
        out = []
        if ours.num_rows and theirs.num_rows:
            points, ids = _matrix(ours.column("v")), ours.column("vec_id").to_numpy()
            cell = ours.column("cell").to_numpy()
            lowest, bits = theirs.column("lowest").to_pylist(), theirs.column("cells").to_pylist()
            asked_by = theirs.column("query_id").to_pylist()
            for i, q in enumerate(_matrix(theirs.column("q"))):
                inside = has_bit(cell, lowest[i], bits[i])
                near, distance = nearest(q, points[inside], ids[inside], asked_by[i], k)
                out.append(pa.table({"query_id": pa.array([asked_by[i]] * len(near), pa.int64()),
                                     "vec_id": near, "score": distance}))
        return pa.concat_tables(out) if out else pa.table(
            {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
             "score": pa.array([], pa.float64())})

    met = entries.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        meet, "query_id long, vec_id long, score double")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The same search with every vector a candidate: what recall is measured against."""
    return search(vectors, every, k, enough=2**62, centroids=2)
