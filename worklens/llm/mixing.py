"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Every document gets a rate between 0 and 2 copies. Among all rates that give each source its target
of words, the ones of largest entropy are exponentially tilted by the document's size:
``2 / (1 + exp(-tilt * size / mean size))``. One tilt a source solves the convex dual, found by
Newton steps kept inside a bracket. The steps run over a histogram of (source, size), so copies
and hot sources are summed before anything is shuffled, and over exact decimal sums, so reruns agree.

Rates are rounded into copies by systematic sampling along a source's documents in order of size:
each prefix of them gets its expected number of extra copies to within one, so the words taken miss
a target by no more than one large document.

Defined results: a NULL text has size 0; a NULL source is a source of its own, last in order;
documents of size 0 take nothing; equal rows are rounded one by one; no rows give no rows; a source
without words has target 0; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from worklens.llm.common import columns, saved

WEIGHTS = (3, 1, 2)
#: Words of the mix for each word there is; and the most copies of a document or source.
SHARE, MOST = 1.5, 2
STEPS = 40
#: Rates are whole millionths.
UNIT = 1_000_000
#: Rows of equal source and size that are numbered together, at least; where there are many, both the
#: rows of a cell and the cells grow with the root of their number.
CELL = 256

EXACT = "decimal(38,0)"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, row_hash): size is the number of words of the whole text."""
    rows = columns(docs, doc_id="long", text="string", source="string")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return rows.select(
        "doc_id", "source", F.coalesce(words, F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", F.xxhash64("text")).alias("row_hash"))


def targets(histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight, filled up to each source's limit.

    Sources whose limit is low for their weight fill first; what they leave is shared by the rest.
    That is one running sum over one row a source.
    """
    per_source = histogram.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double")
    rows = per_source.withColumn("weight", weight).withColumns({
        "limit": (most * F.col("source_size")).cast("double"),
        "total": share * F.sum("source_size").over(Window.partitionBy()).cast("double"),
    })
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    from_here = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # what a unit of weight gets if all before are full
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight").over(from_here)
    rows = rows.withColumn("level", level)
    full = F.col("limit") <= F.col("level") * F.col("weight")
    # the first source that is not full sets the level of all that are not
    rows = rows.withColumn("open_level", F.first(F.when(~full, F.col("level")), True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit"), F.coalesce(F.col("open_level") * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


def rate(tilt: Column, size: Column, mean: Column, most: int = MOST) -> Column:
    """Millionths of copies of a document of ``size``."""
    return F.round(UNIT * most / (1 + F.exp(-tilt * size / mean))).cast("long")


def tilts(histogram: DataFrame, goals: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """``goals`` with ``mean`` (size of a document with words) and ``tilt``.

    Newton's step is taken where it stays within the bracket of the signs seen so far, else the
    bracket is halved, or doubled while it has no end. Sources at their limit or at 0 need no
    finite tilt and get one beyond all rates' rounding.
    """
    worded = histogram.where("size > 0")
    mean = worded.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    share = F.col("target") / (F.col("mean") * F.col("count") * most)
    count = worded.groupBy("source").agg(F.sum("n").alias("count"))
    state = goals.join(mean.withColumnRenamed("source", "s1"), F.col("source").eqNullSafe(
        F.col("s1")), "left").drop("s1")
    state = state.join(count.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(
        F.col("s2")), "left").drop("s2")
    done = F.when(F.col("mean").isNull(), F.lit(0.0)).when(
        share >= 1 - 1e-9, F.lit(1e9)).when(share <= 1e-9, F.lit(-1e9))
    state = state.select(
        "source", "source_size", "target", "mean", done.isNotNull().alias("done"),
        F.coalesce(done, F.lit(0.0)).alias("tilt"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"))
    state = saved(state)
    for _ in range(steps):
        if not state.where("not done").limit(1).count():
            break
        open_ = state.where("not done").select(
            F.col("source").alias("s"), F.col("mean").alias("m"), F.col("tilt").alias("t"))
        r = rate(F.col("t"), F.col("size"), F.col("m"), most)
        words = F.col("n").cast(EXACT) * F.col("size") * r
        slope = words * F.col("size") * (most * UNIT - r) / (most * UNIT)
        moved = (worded.join(open_, F.col("source").eqNullSafe(F.col("s")))
                 .groupBy("s", "m")
                 .agg((F.sum(words).cast("double") / UNIT).alias("taken"),
                      (F.sum(slope.cast(EXACT)).cast("double") / UNIT / F.col("m")).alias("slope"))
                 .drop("m"))
        over = F.col("taken") - F.col("target")
        both = state.join(moved, F.col("source").eqNullSafe(F.col("s")), "left")
        both = both.withColumns({
            "low": F.when(over < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(over > 0, F.col("tilt")).otherwise(F.col("high")),
        })
        newton = F.col("tilt") - F.try_divide(over, F.col("slope"))
        outside = newton.isNull() | (newton <= F.coalesce("low", newton - 1)) | (
            newton >= F.coalesce("high", newton + 1)) | (
            F.abs(newton - F.col("tilt")) > 4 * (1 + F.abs("tilt")))
        other = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(),
                       (F.col("low") + F.col("high")) / 2).otherwise(
            F.col("tilt") - F.signum(over) * 2 * (1 + F.abs("tilt")))
        step = F.when(outside, other).otherwise(newton)
        near = (F.abs(over) <= 1e-6 * F.greatest(F.col("target"), F.lit(1.0))) | (
            F.col("high") - F.col("low") < 1e-9)
        finished = F.col("done") | F.coalesce(near, F.lit(False))
        state = saved(both.select(
            "source", "source_size", "target", "mean", finished.alias("done"),
            F.when(finished, F.col("tilt")).otherwise(F.round(step, 9)).alias("tilt"), "low", "high"))
    return state.select("source", "source_size", "target", "mean", "tilt")


def mix(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """(doc_id, row_hash, source, size, source_size, target, copies, taken) of every document."""
    rows = saved(sizes(docs))
    histogram = saved(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = saved(targets(histogram))
    state = tilts(histogram, goals).withColumnRenamed("source", "s")
    # rates by (source, size), and in how many cells its documents are dealt
    rated = histogram.join(state, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "size", "source_size", "target",
        F.coalesce(rate(F.col("tilt"), F.col("size"), F.col("mean")), F.lit(0)).alias("rate"),
        F.ceil(F.col("n") / F.greatest(F.lit(cell), F.sqrt("n"))).alias("cells"), "n")
    rated = rated.withColumn("part", F.col("rate") % UNIT)
    # expected extra copies before a size, in millionths; half a copy ahead makes rounding fair
    before = Window.unboundedPreceding, -1
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(*before)
    ahead_of_size = F.coalesce(
        F.sum(F.col("n").cast(EXACT) * F.col("part")).over(smaller), F.lit(0).cast(EXACT))
    rated = saved(rated.withColumn("size_begin", ahead_of_size + UNIT // 2).drop("n"))
    rated = rated.withColumnsRenamed({"source": "s", "size": "z"})
    dealt = rows.join(
        rated, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    dealt = dealt.withColumn("cell", F.pmod("row_hash", "cells"))
    same = ["source", "size", "cell"]
    cells = dealt.groupBy(*same).agg(
        F.count(F.lit(1)).alias("m"), F.first("part").alias("part"),
        F.first("size_begin").alias("size_begin"))
    # and before a cell: rows of one size differ in nothing but their cell
    ahead = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(*before)
    begin = F.col("size_begin") + F.coalesce(
        F.sum("m").over(ahead), F.lit(0)).cast(EXACT) * F.col("part")
    cells = cells.select(F.col("source").alias("s"), F.col("size").alias("z"),
                         F.col("cell").alias("c"), begin.alias("begin"))
    number = F.row_number().over(Window.partitionBy(*same).orderBy("row_hash", "doc_id"))
    placed = dealt.withColumn("number", number).join(
        cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
        & (F.col("cell") == F.col("c")))
    upto = F.col("begin") + F.col("number").cast(EXACT) * F.col("part")
    extra = F.floor(upto / UNIT) - F.floor((upto - F.col("part")) / UNIT)
    copies = (F.floor(F.col("rate") / UNIT) + extra).cast("long")
    return placed.select("doc_id", "row_hash", "source", "size", "source_size", "target",
                         copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, with all its columns; those taken 0 times go.

    Repeated rows are matched one by one with their copies.
    """
    same = Window.partitionBy("_id", "_hash")
    numbered = docs.withColumns({
        "_id": F.col("doc_id").cast("long"),
        "_hash": F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))),
    }).withColumn("_number", F.row_number().over(same.orderBy("source")))
    taken = mix(docs).select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "source",
                             "copies")
    taken = taken.withColumn("_number", F.row_number().over(same.orderBy("source", "copies")))
    taken = taken.where("copies > 0").select(
        F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.col("_number").alias("_n"),
        F.col("copies").alias("_copies"))
    found = numbered.join(
        taken, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))
        & (F.col("_number") == F.col("_n")))
    repeated = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.select(*[f"`{c}`" for c in docs.columns])
