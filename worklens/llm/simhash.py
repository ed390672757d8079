"""SimHash near-duplicates: exact links within three bits by vantage-point shards, then components.

Fingerprints are 64 bits over the word shingles of a text. Equal fingerprints are one point, so a
group of copies of any size is one row from there on. The points are split by a vantage-point tree:
at each level a point lies inside or outside a ball around the level's vantage point. By the
triangle inequality two points that are within ``RADIUS`` of each other but on different sides both
lie within ``RADIUS`` of the ball's surface, so only those boundary points are sent on, as the two
sides of a shard of their own; every other pair across the ball is pruned. Each pair within the
radius thus meets in exactly one shard, where distances are computed exactly.

A shard sends one row for each of its linked points, never its pairs. Components follow from those
rows by rounds of minimum labels and shortcuts.

Defined results: NULL and empty texts have fingerprint zero, linked like any other; a text of fewer
words than a shingle is one shingle; equal rows get equal results; a component's id is its smallest
doc_id (NULL only if all are NULL); no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from worklens.llm.common import bounded_batches, columns, hash_sample, keep_rows, saved, text_key, utf8

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Points that choose the vantage points, however many there are.
SAMPLE = 4096
#: Points that a shard should hold; the depth of the tree follows from it.
SHARD = 4096
#: A shard with more points than this is dealt out as blocks that meet pairwise.
LARGEST = 16384


# -- fingerprints ------------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes, repeats included; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z, and exactly the contract's white space
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    k = max(1, len(words) - size + 1)
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[a:b], SEED) for a, b in zip(
        start[:k].tolist(), end[len(words) - k:].tolist())], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for a in range(0, k, 65_536):
        bits = np.unpackbits(hashes[a:a + 65_536].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > k, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp): fp is the fingerprint's 64 bits as a signed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in utf8(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_key", "fp"])

    bounded_batches(docs.sparkSession)
    rows = columns(docs, doc_id="long", text="string").withColumn("text_key", text_key())
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


# -- vantage-point shards ----------------------------------------------------------------------


def distances(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point).astype(np.int16)


def plant(sample: np.ndarray, points: int, shard: int = SHARD) -> list[tuple[np.uint64, int]]:
    """(vantage point, ball radius) of each level, from a bounded sample of the points.

    Of some candidates a level takes the one whose best ball leaves the fewest pairs: those within a
    side, and those between the two boundary bands.
    """
    depth = max(0, int(np.ceil(np.log2(max(1, points) / shard))))
    rng = np.random.default_rng(SEED)
    levels: list[tuple[np.uint64, int]] = []
    for _ in range(depth):
        best = None
        for point in rng.choice(sample, size=min(32, len(sample)), replace=False):
            d = distances(sample, point)
            share = np.bincount(d, minlength=BITS + RADIUS + 1) / len(sample)
            inside = np.cumsum(share)
            for radius in range(1, BITS):
                a = inside[radius]
                band = inside[radius] - (inside[radius - RADIUS] if radius >= RADIUS else 0.0)
                beyond = inside[radius + RADIUS] - inside[radius]
                cost = a * a + (1 - a) ** 2 + 2 * band * beyond
                if best is None or cost < best[0]:
                    best = (cost, point, radius)
        levels.append(best[1:])
    return levels


def placed(points: np.ndarray, levels: list[tuple[np.uint64, int]]):
    """(point index, shard, side) for every shard a point belongs to.

    A shard is the list of its turns, two bits a level. While a set is joined with itself its side
    is 0; where it met its boundary, sides are 1 and 2.
    """
    at = np.arange(len(points))
    shard = np.zeros(len(points), dtype=np.int64)
    side = np.zeros(len(points), dtype=np.int8)
    for vantage, radius in levels:
        away = distances(points, vantage)[at] - radius  # up to 0: inside
        inner = (away <= 0) & (away > -RADIUS)
        outer = (away > 0) & (away <= RADIUS)
        parts = [(at, shard * 4 + (away > 0), side)]  # the side of the ball it lies on
        own = side == 0
        for rows, turn, to in (
            (own & inner, 2, 1), (own & outer, 2, 2),  # the ball's surface, inner against outer
            ((side == 1) & inner, 2, 1), ((side == 2) & outer, 2, 2),
            ((side == 1) & outer, 3, 1), ((side == 2) & inner, 3, 2),
        ):
            parts.append((at[rows], shard[rows] * 4 + turn,
                          np.full(int(rows.sum()), to, dtype=np.int8)))
        at, shard, side = (np.concatenate(x) for x in zip(*parts))
    return at, shard, side


def linked(points: np.ndarray, side: np.ndarray, block: int = 512):
    """(point, its group's first point) for what is linked within a shard, at most one a point."""
    group = np.arange(len(points))
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    for i in range(0, len(left), block):
        rows = left[i:i + block]
        near = np.bitwise_count(points[rows][:, None] ^ points[right][None, :]) <= RADIUS
        itself = side[rows] == 0  # a point of a set joined with itself is near itself
        for k in np.flatnonzero(near.sum(axis=1) > itself):
            met = np.unique(np.append(group[right[near[k]]], group[rows[k]]))
            if len(met) > 1:
                group[np.isin(group, met[1:])] = met[0]
    moved = np.flatnonzero(group != np.arange(len(points)))
    return points[moved], points[group[moved]]


def links(points: DataFrame, shard: int = SHARD, largest: int = LARGEST) -> DataFrame:
    """(a, b): links whose closure is that of all pairs of ``points.fp`` within the radius.

    ``points`` is saved and its ``fp`` are distinct. The sample is the ``SAMPLE`` points of the
    smallest hash; the tree made from it is bounded by its depth.
    """
    spark = points.sparkSession
    sample = hash_sample(points, SAMPLE, "fp").toArrow().column("fp")
    sample = np.asarray(sample.to_numpy(), dtype=np.int64).view(np.uint64)
    levels = plant(sample, points.count(), shard) if len(sample) else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fps), 8192):
                own = fps[i:i + 8192]
                at, to, side = placed(own, levels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[at].view(np.int64)), pa.array(to), pa.array(side)],
                    names=["fp", "shard", "side"])

    rows = points.select("fp").mapInArrow(place, "fp long, shard long, side byte")
    # a shard that is still too large is cut into blocks, and each block meets each other once
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > largest)
    sizes = saved(sizes.select("shard", F.ceil(F.col("n") / (largest // 2)).cast("int").alias("k")))
    if sizes.limit(1).count():
        own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
        rows = rows.join(sizes, "shard", "left").withColumn(
            "k", F.coalesce("k", F.lit(1))).withColumn("own", own).withColumn("other", other)
        rows = rows.select("fp", "shard", "side", F.least("own", "other").alias("p"),
                           F.greatest("own", "other").alias("q"))
    else:
        rows = rows.withColumns({"p": F.lit(0), "q": F.lit(0)})

    def match(key, table):
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = linked(fps, table.column("side").to_numpy())
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return rows.groupBy("shard", "p", "q").applyInArrow(match, "a long, b long").where(
        F.col("a") != F.col("b")).distinct()


# -- components --------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(point, root): the smallest point reachable from each point that has a link.

    Each round hangs every neighbour of a point, and the point itself, on its smallest neighbour
    (large star, then small star); rounds follow the logarithm of the longest chain. The links stay
    on the executors; each round is saved in the shared folder.
    """
    def star(pairs: DataFrame, larger_only: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger_only:
            both = both.where(F.col("b") < F.col("a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        near = both.join(least, "a")
        if larger_only:
            return near.where(F.col("b") > F.col("a")).select(
                F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        return near.where(F.col("b") != F.col("least")).select(
            F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
                least.select("a", F.col("least").alias("b"))).distinct()

    pairs = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a != b").distinct())
    digest = None
    while True:
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == digest or not now[0]:
            return pairs.select(F.col("a").alias("point"), F.col("b").alias("root"))
        digest = now
        pairs = saved(star(star(pairs, True).where("a != b"), False).where("a != b"))


def components_of(docs: DataFrame, shard: int = SHARD, largest: int = LARGEST) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) of every row of ``docs``.

    ``root`` is the component's smallest fingerprint, its own whatever the ids are.
    """
    rows = saved(fingerprints(docs))
    points = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(points, shard, largest))
    joined = points.join(roots, F.col("fp") == F.col("point"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = saved(joined.groupBy("root").agg(F.min("least").alias("component_id")))
    named = joined.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every document."""
    return components_of(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def filter_documents(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: a row of the smallest doc_id.

    A component without ids keeps one row too, and components that share an id keep one each.
    """
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    one = components_of(docs).groupBy("root").agg(F.min(first).alias("one"))
    kept = keep_rows(docs, one.select("one.doc_id", "one.text_key"))
    return kept.withColumn("_key", text_key()).dropDuplicates(["doc_id", "_key"]).drop("_key")
