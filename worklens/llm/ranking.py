"""Quality classifier by Bradley-Terry ranking: scores learned from pairs of documents.

A pair says that one document (labelled 1) is preferred to another (labelled 0). The weights of a
linear score maximise the likelihood of the preferences: logistic loss on the difference of the two
documents' features, no intercept, by Newton's steps. Spark sums each step's gradient and curvature
over all pairs as whole numbers, so the weights do not depend on the order or partitions of the rows.
The verdict's threshold is a quantile of the scores of the labelled documents, the one at which the
two labels are told apart best; scores are counted on a fine grid between the least and the largest.
Every labelled document is learned from.

Pairs come from an equality join: in each round every labelled document draws a slot by hash, and
documents of different labels that share a slot make a pair; the slots are as many as the rarer
label has documents, so the pairs grow with the documents and not with their product.

Defined results: NULL and empty texts are scored like texts without words; without labels of both
kinds every score is 0.5; equal texts get equal scores; other columns pass through; no rows give no
rows. Labels, language, source and id are no features.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from worklens.llm.common import bounded_batches, columns, saved, slices
from worklens.llm.spans import mix, span_hashes, sums, words_of

ROUNDS = 6
#: Labelled ids that may be broadcast, so that features are made of their texts only.
IDS = 500_000
#: Documents of the rarer label that may be broadcast to meet the others: 200 bytes each.
RARE = 50_000
#: Weight of the squared weights, as if features had variance one; most steps; the step that ends them.
PENALTY, STEPS, ENOUGH = 1e-3, 60, 1e-9
#: Steps of the grid that scores are counted on.
GRID = 1 << 16
#: The score at and above which a document is predicted to be good.
CUT = 0.7

_CLASS = np.zeros((8, 256), dtype=bool)
_CLASS[0, ord("A"):ord("Z") + 1] = True  # fixed values: kinds of bytes
_CLASS[1, ord("0"):ord("9") + 1] = True
_CLASS[2, list(b"#*$%&<>@^~=+_\\/{}[]")] = True
_CLASS[3, list(b"!?")] = True
_CLASS[4, list(b"|")] = True
_CLASS[5, list(b".,;:")] = True
_CLASS[6, list(b"\n")] = True
_CLASS[7, 0x80:] = True


def features(texts: list[bytes]) -> np.ndarray:
    """One row a text; all values are bounded or logarithms."""
    w = words_of(texts)
    n = np.diff(w.first)
    at_least = np.maximum(n, 1)
    size = np.maximum(np.diff(w.text_start) - 1, 1)
    text = np.repeat(np.arange(len(texts)), n)
    hashes = span_hashes(w.buf, w.start, w.end)
    kinds = [sums(kind[w.buf], w.text_start) for kind in _CLASS]
    kinds[6] = kinds[6] - 1  # the line feed put after each text

    def repeated(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Keys of a text that occurred in it before."""
        _, first = np.unique(mix(keys + mix(of.astype(np.uint64))), return_index=True)
        return np.bincount(of, minlength=len(texts)) - np.bincount(of[first], minlength=len(texts))

    next_same = np.zeros(len(hashes), dtype=bool)
    next_same[:-1] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    inside = np.flatnonzero(text[2:] == text[:-2]) if len(text) > 2 else np.zeros(0, dtype=np.int64)
    triples = mix(mix(hashes[inside]) + mix(hashes[inside + 1]) * np.uint64(3)
                  + hashes[inside + 2]) if len(inside) else np.zeros(0, dtype=np.uint64)
    length = w.end - w.start
    long_words = sums(length > 12, w.first)
    short_words = sums(length <= 3, w.first)
    upper = _CLASS[0][w.buf]
    total_upper = np.concatenate(([0], np.cumsum(upper)))
    shouting = sums((total_upper[w.end] - total_upper[w.start] >= 2), w.first)
    symbols = np.concatenate(([0], np.cumsum(_CLASS[2][w.buf] | _CLASS[4][w.buf] | _CLASS[3][w.buf])))
    marked = sums(symbols[w.end] > symbols[w.start], w.first)
    return np.column_stack([
        np.minimum(np.log1p(n), np.log1p(50)), np.log1p(n) / 10,
        sums(length, w.first) / at_least / 10,
        *(k / size for k in kinds),
        repeated(hashes, text) / at_least, sums(next_same, w.first) / at_least,
        repeated(triples, text[inside] if len(inside) else np.zeros(0, dtype=np.int64)) / at_least,
        long_words / at_least, short_words / at_least, shouting / at_least, marked / at_least,
    ])


class Ranker(NamedTuple):
    """Score = 1 / (1 + exp(-(x.weights - threshold) / spread - logit(CUT)))."""

    weights: list[float]
    threshold: float
    spread: float


def _features_udf():
    @F.arrow_udf("array<double>")
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in column:
            data = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
            rows = [r for a, b in slices(data) for r in features(data[a:b]).tolist()]
            yield pa.array(rows, pa.list_(pa.float64()))

    return run.asNondeterministic()  # not to be computed twice


def pairs_of(labelled: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(label, features): differences of preferred and other documents, turned about by hash.

    ``labelled`` is saved and has ``key``, ``quality`` and ``x``.
    """
    count = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    slots = max(1, min(count.values(), default=1))
    drawn = labelled.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn(
        "slot", F.pmod(F.xxhash64("key", "round"), F.lit(slots)))
    good = drawn.where("quality = 1").select("round", "slot", "x", F.col("key").alias("a"))
    bad = drawn.where("quality = 0").select("round", "slot", F.col("x").alias("y"),
                                            F.col("key").alias("b"))
    if slots <= RARE:  # few slots may hold very many documents of the other label
        rarer = min(count, key=count.get, default=0)
        good, bad = (good, F.broadcast(bad)) if rarer == 0 else (F.broadcast(good), bad)
    turned = F.when(F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    difference = F.zip_with("x", "y", lambda p, q: F.col("sign") * (p - q))
    return good.join(bad, ["round", "slot"]).withColumn("sign", turned).select(
        ((F.col("sign") + 1) / 2).alias("label"), difference.alias("features"))


def _whole(values: np.ndarray, bits: int) -> np.ndarray:
    """Column sums of ``values`` rounded to 2^-bits, exact and so the same in any order."""
    return np.rint(values * 2.0**bits).astype(np.int64).sum(axis=0)


def _summed(pairs: DataFrame, parts) -> np.ndarray:
    """Sums over all rows of ``parts(signed features) -> whole numbers``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
                total = parts(x * (2 * batch.column("label").to_numpy() - 1)[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)],
                                                 names=["at", "n"])

    rows = pairs.mapInArrow(run, "at int, n long").groupBy("at").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    return np.array([float(r["n"]) for r in sorted(rows, key=lambda r: r["at"])])


def weights_of(pairs: DataFrame) -> np.ndarray:
    """The weights of the largest penalised likelihood of ``pairs`` (saved), from all of them."""
    some = pairs.select(F.size("features").alias("n")).first()
    if some is None:  # no two documents met
        return np.zeros(len(features([b""])[0]))
    peak = pairs.agg(*(F.max(F.abs(F.col("features")[j])).alias(f"x{j}") for j in range(some["n"]))).first()
    unit = np.array([2.0 ** np.ceil(np.log2(v)) if v else 1.0 for v in peak])  # squares of at most 1
    squares = _summed(pairs, lambda d: np.append(_whole((d / unit) ** 2, 48), len(d)))
    n, scale = squares[-1], unit * np.sqrt(squares[:-1] / 2.0**48 / squares[-1])
    used = np.flatnonzero(scale > 0)
    size, scale = len(used), scale[used]
    row, column = np.triu_indices(size)
    w, step, loss = np.zeros(size), np.zeros(size), np.inf
    for _ in range(STEPS):
        def parts(d: np.ndarray, at=w) -> np.ndarray:
            d = d[:, used] / scale
            margin = np.zeros(len(d))
            for j in range(size):  # one by one: the same sum whatever the batch
                margin += d[:, j] * at[j]
            lost = np.logaddexp(0, -margin)
            wrong = np.exp(-lost - margin)  # 1 / (1 + exp(margin))
            bent = wrong * (1 - wrong)
            return np.concatenate([_whole(lost[:, None], 30), _whole(d * wrong[:, None], 36),
                                   _whole(d[:, row] * d[:, column] * bent[:, None], 30)])

        total = _summed(pairs, parts)
        now = total[0] / 2.0**30 / n + PENALTY / 2 * float(w @ w)
        if now > loss + 1e-9:  # too far
            step = step / 2
            w = w - step
            continue
        loss = now
        slope = total[1:size + 1] / 2.0**36 / n - PENALTY * w
        curve = np.zeros((size, size))
        curve[row, column] = curve[column, row] = total[size + 1:] / 2.0**30 / n
        step = np.linalg.solve(curve + PENALTY * np.eye(size), slope)
        w = w + step
        if np.abs(step).max(initial=0) < ENOUGH:
            break
    out = np.zeros(len(squares) - 1)
    out[used] = w / scale
    return out


def threshold_of(labelled: DataFrame, weights: list[float]) -> tuple[float, float]:
    """(threshold, deviation) of the scores of all of ``labelled`` (saved), counted on a grid."""
    products = F.zip_with("x", F.array(*map(F.lit, weights)), lambda p, q: p * q)
    scored = labelled.select("quality", F.aggregate(products, F.lit(0.0), lambda a, v: a + v).alias("score"))
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    width = max((high - low) / GRID, 1e-12)
    place = F.floor((F.col("score") - low) / width).cast("long")
    rows = scored.groupBy(place.alias("at"), "quality").count().collect()  # at most two a grid step
    at, quality, count = (np.array([r[i] for r in sorted(rows)]) for i in range(3))
    places = np.unique(at)
    good, bad = (np.bincount(np.searchsorted(places, at[quality == k]), weights=count[quality == k],
                             minlength=len(places)) for k in (1, 0))
    every = np.cumsum(good + bad)
    best = None
    for q in np.linspace(0.005, 0.995, 199):
        i = int(np.searchsorted(every, q * (every[-1] - 1), side="right"))
        gain = good[i:].sum() / good.sum() - bad[i:].sum() / bad.sum()
        if best is None or gain > best[0] + 1e-12:
            best = (gain, float(low + width * int(places[i])))
    mean = (places * (good + bad)).sum() / every[-1]
    spread = width * np.sqrt(((places - mean) ** 2 * (good + bad)).sum() / every[-1])
    return best[1], float(max(spread, 1e-6))


def learn(docs: DataFrame, labels: DataFrame) -> Ranker | None:
    """Fit on every labelled document; None without both labels."""
    texts = columns(docs, doc_id="long", text="string")
    known = saved(columns(labels, doc_id="long", quality="int").where(
        "quality in (0, 1) and doc_id is not null").distinct())
    if known.limit(IDS + 1).count() <= IDS:
        texts = texts.join(F.broadcast(known.select("doc_id").distinct()), "doc_id", "left_semi")
    # one text of each labelled document (that of the smallest hash, if rows share the id); features
    # are made first, so no text is shuffled
    key = F.xxhash64("doc_id", "text")
    rows = texts.where("doc_id is not null").select(
        "doc_id", key.alias("key"), _features_udf()("text").alias("x"))
    one = rows.groupBy("doc_id").agg(F.min_by("x", "key").alias("x"), F.min("key").alias("key"))
    labelled = saved(one.join(known, "doc_id").select("quality", "key", "x"))
    if labelled.select("quality").distinct().count() < 2:
        return None
    weights = [float(v) for v in weights_of(saved(pairs_of(labelled)))]
    return Ranker(weights, *threshold_of(labelled, weights))


def scorer(spark: SparkSession, ranker: Ranker | None):
    """A column function: text to a score between 0 and 1."""
    held = None if ranker is None else tuple(ranker)

    @F.arrow_udf("double")
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in column:
            data = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
            if held is None:
                yield pa.array([0.5] * len(data), pa.float64())
                continue
            weights, threshold, spread = held
            # row by row products: the same sum whatever the batch
            raw = [sum(p * q for p, q in zip(row, weights))
                   for a, b in slices(data) for row in features(data[a:b]).tolist()]
            z = (np.array(raw) - threshold) / spread + np.log(CUT / (1 - CUT))
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())

    return run.asNondeterministic()  # not to be computed twice


def is_held_out() -> Column:
    """Documents whose labels are not learned: a remainder of the id's checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    rest = docs.drop("held_out", "score", "predicted")
    names = [F.col(f"`{c}`") for c in rest.columns]
    ranker = learn(rest.where(~is_held_out()), labels.where(~is_held_out()))
    score = scorer(docs.sparkSession, ranker)(F.col("text").cast("string"))
    return rest.select(*names, is_held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
