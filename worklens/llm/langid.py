"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of the vocabulary. A word's likelihood sums over all
its segmentations (forward algorithm); a text's is the product over its words: runs of letters,
lower-cased, a space in front. The probabilities are learned by expectation maximisation: Spark
counts the words of a bounded sample of labelled documents, and each round adds up expected piece
counts over the executors.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; without any labelled
document every text is ``und``; ties go to the smallest language; equal texts get equal results;
other columns pass through; no rows give no rows. The score is the posterior of the predicted
language under equal priors.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from worklens.llm.common import bounded_batches, columns, hash_sample_by, saved
from worklens.llm.sentences import VOCABULARY, coder
from worklens.llm.trie import forward, lattice, piece_weights, ragged

UNDETERMINED = "und"
#: Labelled documents that a language is learned from, the ones of the smallest hash.
SAMPLE = 1500
ROUNDS = 3
#: Added to each piece's expected count.
PRIOR = 0.05
#: Words whose likelihoods a task remembers.
REMEMBERED = 200_000
#: Distinct words put into one lattice.
LATTICE_WORDS = 20_000

#: Runs of letters and, as the re module has no class of letters alone, of numerals such as fractions.
_LETTERS = re.compile(r"[^\W\d_]+")
_NUMERALS = re.compile("[" + "".join(c for c in map(chr, range(sys.maxunicode + 1))
                                     if c.isalnum() and not c.isalpha()) + "]+")


def words_of(text: str) -> list[str]:
    found = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for x in found for w in ([x] if x.isalpha() else _NUMERALS.split(x)) if w]


def _buffer(words: list[str]):
    """The words with a space in front, apart by a line feed."""
    data = [b" " + w.encode("utf-8", "replace") for w in words]
    length = np.array([len(x) for x in data])
    start = np.concatenate(([0], np.cumsum(length + 1)[:-1]))
    return np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8), start, start + length


def log_likelihoods(own: tuple, words: list[str]) -> np.ndarray:
    """One row a word, one column a language."""
    trie, byte_id, logp = own
    out = []
    for i in range(0, len(words), LATTICE_WORDS):
        buf, start, end = _buffer(words[i:i + LATTICE_WORDS])
        edges = lattice(trie, buf, start, end)
        weight = piece_weights(edges, buf, logp, byte_id)
        out.append(forward(edges, weight, len(buf) + 1)[end])
    return np.concatenate(out) if out else np.zeros((0, logp.shape[1]))


def expected_counts(own: tuple, words: list[str], n: np.ndarray, language: np.ndarray):
    """(language, piece, expected count) over all segmentations of counted words."""
    trie, byte_id, logp = own
    buf, start, end = _buffer(words)
    edges = lattice(trie, buf, start, end)
    size = end - start
    word = np.zeros(len(buf) + 1, dtype=np.int64)  # of each position, its word
    word[ragged(start, size + 1)] = np.repeat(np.arange(len(words)), size + 1)
    at = word[edges.frm]
    column = language[at]
    # one column: of each edge, that of its word's language
    weight = logp[edges.piece, column]
    lacking = np.flatnonzero(edges.piece < 0)
    bytes_of = [(lacking[edges.frm[lacking] + k < edges.to[lacking]], k) for k in range(4)]
    weight[lacking] = 0
    for have, k in bytes_of:
        weight[have] += logp[byte_id[buf[edges.frm[have] + k]], column[have]]
    alpha = forward(edges, weight, len(buf) + 1)
    order = np.lexsort((edges.frm, end[at] - edges.frm))
    back = edges._replace(frm=edges.to[order], to=edges.frm[order],
                          level=(end[at] - edges.frm)[order])
    beta = forward(back, weight[order], len(buf) + 1)
    share = np.exp(alpha[edges.frm] + weight + beta[edges.to] - alpha[end][at]) * n[at]
    pieces, columns_, shares = [edges.piece], [column], [share]
    for have, k in bytes_of:
        pieces.append(byte_id[buf[edges.frm[have] + k]])
        columns_.append(column[have])
        shares.append(share[have])
    pieces[0] = np.where(edges.piece < 0, len(logp) - 1, edges.piece)
    key = np.concatenate(columns_) * len(logp) + np.concatenate(pieces)
    total = np.bincount(key, weights=np.concatenate(shares), minlength=logp.shape[1] * len(logp))
    found = np.flatnonzero(total)
    found = found[found % len(logp) != len(logp) - 1]
    return found // len(logp), found % len(logp), total[found]


def learn(labelled: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE,
          rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each piece in each) from (doc_id, text, lang).

    What the driver holds is languages times pieces. The sample is at most ``sample`` whole
    documents a language; a filter on their hash leaves few more than that to be shuffled.
    """
    spark = labelled.sparkSession
    rows = columns(labelled, doc_id="long", text="string", lang="string").where(
        "lang is not null and text is not null")
    chosen = hash_sample_by(rows.withColumn("key", F.xxhash64("text")), "lang", sample, "doc_id", "key")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((lang, w) for w in words_of(text))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()),
                 pa.array([k[1] for k in keys], pa.string()),
                 pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "word", "n"])

    counted = saved(chosen.select("lang", "text").mapInArrow(
        count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    own = coder(path)
    pieces = len(own.score)
    start = np.where(np.isin(np.arange(pieces), own.byte_id), -20.0, own.score)
    logp = np.repeat(start[:, None], len(languages), axis=1)
    for _ in range(rounds if languages else 0):
        held = spark.sparkContext.broadcast((own.trie, own.byte_id, logp, languages))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            *model, langs = held.value
            number = {lang: i for i, lang in enumerate(langs)}
            for batch in batches:
                column = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
                if len(column):
                    found = expected_counts(
                        tuple(model), batch.column("word").to_pylist(),
                        batch.column("n").to_numpy().astype(float), column)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[0]), pa.array(found[1]), pa.array(found[2])],
                        names=["g", "piece", "c"])

        # sums of millionths: the same whatever the order of the rows
        sums = counted.mapInArrow(expect, "g long, piece long, c double").groupBy("g", "piece").agg(
            F.sum(F.round(F.col("c") * 1e6).cast("decimal(38,0)")).cast("double").alias("c"))
        got = sums.toArrow().to_pandas()
        total = np.full((pieces, len(languages)), PRIOR)
        total[got["piece"], got["g"]] += got["c"].to_numpy() / 1e6
        logp = np.log(total) - np.log(total.sum(axis=0))
        held.destroy()
    return languages, logp


def predictor(spark: SparkSession, model: tuple[list[str], np.ndarray], path: str = VOCABULARY):
    """A column function: text to ``struct<lang_pred, score>``."""
    languages, logp = model
    own = coder(path)
    held = spark.sparkContext.broadcast((own.trie, own.byte_id, logp, languages))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        *tables, langs = held.value
        known: dict[str, int] = {}
        values = np.zeros((0, len(langs)))

        def judged(texts: list[str | None]):
            nonlocal known, values
            counts = [Counter(words_of(t)) if t else Counter() for t in texts]
            if len(known) > REMEMBERED:
                known, values = {}, np.zeros((0, len(langs)))
            fresh = list(dict.fromkeys(w for c in counts for w in c if w not in known))
            values = np.concatenate([values, log_likelihoods(tuple(tables), fresh)])
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            for c in counts:
                if not c or not langs:
                    yield UNDETERMINED, 0.0
                    continue
                n = np.fromiter(c.values(), dtype=float, count=len(c))
                total = n @ values[np.fromiter((known[w] for w in c), dtype=np.int64, count=len(c))]
                best = int(np.argmax(total))
                yield langs[best], float(1 / np.exp(total - total[best]).sum())

        for texts in column:
            rows = texts.to_pylist()
            out = [x for i in range(0, len(rows), 1000) for x in judged(rows[i:i + 1000])]
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                names=["lang_pred", "score"])

    return predict.asNondeterministic()  # not to be computed twice


def is_held_out() -> Column:
    """Documents nothing is learned from: a remainder of the id's checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``; columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    rest = docs.drop("held_out", "lang_pred", "score")
    model = learn(rest.where(~is_held_out()), path)
    kept = [F.col(f"`{c}`") for c in rest.columns]
    predicted = predictor(docs.sparkSession, model, path)(F.col("text").cast("string"))
    return rest.select(*kept, is_held_out().alias("held_out"), predicted.alias("_predicted")).select(
        *kept, "held_out", F.col("_predicted.lang_pred").alias("lang_pred"),
        F.col("_predicted.score").alias("score"))


def filter_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is determined with a score of at least ``least``."""
    found = identify(docs).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return found.select(*[f"`{c}`" for c in docs.columns])
