"""Quality rules: counted word and line rules, and perplexity bands under a Kneser-Ney model.

The model is a character model of order four per language with modified Kneser-Ney smoothing. Spark
counts the highest order over every distinct text of a language; copies are judged like any row but
set neither model nor band. The lower orders, the discounts and the weights follow
from those counts by DataFrame aggregations. A gram is four 16-bit text units packed in one 64-bit
key, so no two grams share a key. The finished model is a set of sorted hash arrays per language and
order.

Defined results: a NULL text is an empty text; a NULL language is a language of its own; a text
without words fails the base rules; equal rows get equal results; no rows give no rows; other
columns are ignored. A language whose model is empty cannot occur: every row adds to its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from worklens.llm.common import (
    bounded_batches, columns, few_rows, keep_rows, saved, slices, text_key, utf8,
)
from worklens.llm.spans import distinct_spans, mix, sums, windows, words_of

ORDER = 4
#: Grams whose arrays may be broadcast: 16 bytes each, so at most 64 MB.
MODEL_ROWS = 4_000_000
#: A band is the median of a language's log perplexity, give or take so many deviations of a text of
#: that length (they shrink with the root of its length), and never narrower than ``LEAST`` a side.
DEVIATIONS, LEAST = 4.5, 0.05
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rows of one per language that may be broadcast.
LANGUAGES = 10_000
#: Hashes of repeated texts that may be broadcast: some 50 bytes each, so at most about 25 MB.
COPIED = 500_000

BEGIN, END = 0x0002, 0x0003
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


# -- counted rules -----------------------------------------------------------------------------


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = words_of(texts)
    n_words = np.diff(w.first)
    lead = (w.buf & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(lead)))
    _, number = distinct_spans(w.buf, w.start, w.end)
    return {
        "n_words": n_words,
        "word_chars": sums(chars[w.end] - chars[w.start], w.first),
        "n_symbols": sums(_SYMBOL[w.buf], w.text_start),
        "n_dup_lines": _repeated_lines(w),
        "n_repeat_words": _repeated_words(number, w.first),
    }


def _repeated_words(number: np.ndarray, first: np.ndarray) -> np.ndarray:
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    covered = np.zeros(len(number), dtype=bool)
    at, window = windows(number, text, 3)
    ordered = np.sort(window)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        place = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
        again = at[twice[place] == window]
        for k in range(3):
            covered[again + k] = True
    return sums(covered, first)


def _repeated_lines(w) -> np.ndarray:
    end = np.flatnonzero(w.buf == 0x0A)
    start = np.concatenate(([0], end[:-1] + 1))
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[worded], end[worded]
    text = np.searchsorted(w.text_start, start, side="right") - 1
    n_texts = len(w.text_start) - 1
    _, line = distinct_spans(w.buf, start, end)
    _, kept = np.unique(line * n_texts + text, return_index=True)
    return np.bincount(text, minlength=n_texts) - np.bincount(text[kept], minlength=n_texts)


# -- model -------------------------------------------------------------------------------------


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of each text, one for each unit and one for its end; and how many each has."""
    begin, end = chr(BEGIN) * (ORDER - 1), chr(END)
    units = [np.frombuffer((begin + t + end).encode("utf-16-le", "surrogatepass"), dtype="<u2")
             for t in texts]
    all_units = np.concatenate(units).astype(np.uint64)
    packed = all_units[ORDER - 1:].copy()
    for k in range(1, ORDER):
        packed |= all_units[ORDER - 1 - k: len(all_units) - k] << np.uint64(16 * k)
    size = np.array([len(u) for u in units])
    stop = np.cumsum(size) - (ORDER - 1)
    inside = np.ones(len(packed), dtype=bool)
    for k in range(ORDER - 1):  # grams that would span two texts
        over = stop[:-1] + k
        inside[over] = False
    return packed[inside], size - (ORDER - 1)


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[new], np.diff(np.append(new, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(counts, new)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, key, n): how often each gram of the highest order occurs, over every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list] = {}

        def rows(lang):
            keys, n = _counted(np.concatenate([k for k, _ in held[lang]]),
                               np.concatenate([c for _, c in held[lang]]))
            held[lang] = [(keys, n)]
            return len(keys)

        def flush(lang):
            rows(lang)
            (keys, n), = held.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                 pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            by_lang: dict[str | None, list[str]] = {}
            for lang, text in zip(langs, texts):
                by_lang.setdefault(lang, []).append(text or "")
            for lang, own in by_lang.items():
                for a, b in slices(own):
                    held.setdefault(lang, []).append(_counted(_grams(own[a:b])[0]))
                    if len(held[lang]) >= 16 and rows(lang) > 500_000:
                        yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    return (docs.select("lang", "text").mapInArrow(count, "lang string, key long, n long")
            .groupBy("lang", "key").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, size, key, logp, logb): log probability and back-off weight of every gram.

    ``size`` 1 to 4 is the number of units in ``key``; size 0 holds the share of an unseen unit.
    ``logb`` is the weight a context leaves to shorter ones (0 where the gram is no context).
    """
    orders = {ORDER: saved(counts)}
    for size in range(ORDER - 1, 0, -1):  # how many different units come before
        orders[size] = saved(
            orders[size + 1].groupBy("lang", _last(size).alias("key"))
            .agg(F.count(F.lit(1)).alias("n")))
    shorter = orders[1].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("p"))
    shorter = shorter.withColumn("key", F.lit(0).cast("long"))
    parts = [shorter.select("lang", F.lit(0).alias("size"), "key", F.log("p").alias("logp"),
                            F.lit(None).cast("double").alias("logb"))]
    for size in range(1, ORDER + 1):
        same = Window.partitionBy("lang", "context")
        grams = (
            _discounted(orders[size])
            .withColumn("context", F.shiftrightunsigned("key", 16))
            .withColumn("total", F.sum("n").over(same))
            .withColumn("freed", F.sum("cut").over(same))
            .withColumn("suffix", _last(size - 1)))
        below = shorter.select("lang", F.col("key").alias("suffix"), F.col("p").alias("p_below"))
        level = saved(grams.join(below, ["lang", "suffix"]).select(
            "lang", "key", "context", (F.col("freed") / F.col("total")).alias("left"),
            ((F.col("n") - F.col("cut") + F.col("freed") * F.col("p_below"))
             / F.col("total")).alias("p")))
        parts.append(level.select("lang", F.lit(size).alias("size"), "key",
                                  F.log("p").alias("logp"), F.lit(None).alias("logb")))
        parts.append(level.groupBy("lang", F.lit(size - 1).alias("size"),
                                   F.col("context").alias("key"))
                     .agg(F.lit(None).cast("double").alias("logp"),
                          F.log(F.max("left")).alias("logb")))
        shorter = level
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return saved(table.groupBy("lang", "size", "key").agg(
        F.max("logp").alias("logp"), F.coalesce(F.max("logb"), F.lit(0.0)).alias("logb")))


def _last(size: int):
    """The last ``size`` units of ``key``."""
    return F.col("key").bitwiseAND(F.lit((1 << (16 * size)) - 1))


def _discounted(grams: DataFrame) -> DataFrame:
    """Adds ``cut``, the discount of each count by the modified rule: 1, 2, and 3 or more.

    The discounts are one row a language, and so few that they are broadcast behind a check.
    """
    ones = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in range(1, 5)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int, fallback: float):
        d = F.lit(float(k)) - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        # small counts of counts give no usable estimate
        return F.when((d > 0) & (d < k), d).otherwise(fallback).alias(f"d{k}")

    rates = grams.groupBy("lang").agg(*ones).select(
        "lang", discount(1, 0.5), discount(2, 1.0), discount(3, 1.5))
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(
        F.col("d3"))
    return grams.join(few_rows(saved(rates), LANGUAGES), "lang").select(
        "lang", "key", "n", cut.alias("cut"))


def pack(keys: np.ndarray, *values: np.ndarray) -> tuple:
    """A sorted hash array: hashed keys in order, their values, a directory of leading bits."""
    hashes = mix(keys.astype(np.uint64))
    order = np.argsort(hashes)
    hashes = np.append(hashes[order], np.uint64(2**64 - 1))
    bits = int(len(keys)).bit_length() + 1
    heads = np.arange((1 << bits) + 1, dtype=np.uint64)
    head = np.searchsorted(hashes[:-1] >> np.uint64(64 - bits), heads).astype(np.int32)
    return hashes, [np.append(v[order], 0.0).astype(np.float64) for v in values], head, 64 - bits


def find(packed: tuple, keys: np.ndarray) -> np.ndarray:
    """Where each key is in a sorted hash array, or -1."""
    hashes, _, head, shift = packed
    wanted = mix(keys)
    at = head[(wanted >> np.uint64(shift)).astype(np.int64)]
    behind = np.flatnonzero(hashes[at] < wanted)
    while len(behind):
        at[behind] += 1
        behind = behind[hashes[at[behind]] < wanted[behind]]
    return np.where(hashes[at] == wanted, at, -1)


def log_probabilities(tables: dict[int, tuple], keys: np.ndarray) -> np.ndarray:
    """Of each packed gram under one language's arrays, backing off where it is unknown."""
    out = np.zeros(len(keys))
    missing, rest = np.arange(len(keys)), keys
    for size in range(ORDER, -1, -1):
        at = find(tables[size], rest)
        found = at >= 0
        out[missing[found]] += tables[size][1][0][at[found]]
        if found.all():
            break
        missing, rest = missing[~found], rest[~found]
        context = find(tables[size - 1], rest >> np.uint64(16))
        out[missing] += np.where(context >= 0, tables[size - 1][1][1][context], 0.0)
        rest = rest & np.uint64((1 << (16 * (size - 1))) - 1)
    return out


def hash_arrays(table: DataFrame) -> dict[str, dict[int, tuple]]:
    """The model's rows as sorted hash arrays; only for tables of at most ``MODEL_ROWS`` rows."""
    rows = table.toArrow().to_pandas().fillna({"logp": 0.0, "logb": 0.0})
    return {
        lang: {int(size): pack(t["key"].to_numpy(), t["logp"].to_numpy(), t["logb"].to_numpy())
               for size, t in own.groupby("size")}
        for lang, own in rows.groupby("lang")
    }


# -- scores ------------------------------------------------------------------------------------

SCORED = ("doc_id long, lang string, text_key long, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long, n_grams long, logp double")


def _scored(docs: DataFrame, models: dict[str, dict[int, tuple]] | None) -> DataFrame:
    """Counted rules of every text and, with ``models``, its log probability."""
    held = None if models is None else docs.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for a, b in slices(texts):
                out = base_counts(texts[a:b])
                logp, n_grams = np.zeros(b - a), np.zeros(b - a, dtype=np.int64)
                for lang in set(langs[a:b]):
                    rows = np.array([i for i in range(a, b) if langs[i] == lang]) - a
                    keys, size = _grams([texts[a + i].decode() for i in rows])
                    n_grams[rows] = size
                    if held is not None:
                        logp[rows] = sums(log_probabilities(held.value[lang], keys),
                                          np.concatenate(([0], np.cumsum(size))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in ("doc_id", "lang", "text_key")]
                    + [pa.array(out[c].astype(np.int64)) for c in (
                        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                    + [pa.array(n_grams), pa.array(logp)],
                    names=[c.split()[0] for c in SCORED.split(", ")])

    return docs.mapInArrow(score, SCORED)


def _logp_by_join(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, lang, text_key, logp) for a model too large for one task: grams meet it in a join.

    Each text sends its distinct grams with their counts. Grams that the model lacks back off by
    further joins.
    """
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(utf8(batch.column("text"))):
                keys, n = _counted(_grams([text.decode()])[0])
                same = [pa.array([batch.column(c)[i].as_py()] * len(keys), t) for c, t in (
                    ("doc_id", pa.int64()), ("lang", pa.string()), ("text_key", pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["doc_id", "lang", "text_key", "key", "n"])

    sent = docs.distinct().mapInArrow(
        grams, "doc_id long, lang string, text_key long, key long, n long")
    known = sent.select("lang", F.col("key").alias("gram")).distinct().withColumns(
        {"key": F.col("gram"), "logp": F.lit(None).cast("double"), "weight": F.lit(0.0)})
    for size in range(ORDER, -1, -1):
        level = table.where(F.col("size") == size).select(
            F.col("lang").alias("_l"), F.col("key").alias("_k"), F.col("logp").alias("_p"))
        known = known.join(level, (F.col("lang") == F.col("_l")) & (F.col("key") == F.col("_k"))
                           & F.col("logp").isNull(), "left")
        known = known.withColumn("logp", F.coalesce("logp", F.col("_p") + F.col("weight")))
        known = known.drop("_l", "_k", "_p")
        if size:
            level = table.where(F.col("size") == size - 1).select(
                F.col("lang").alias("_l"), F.col("key").alias("_k"), F.col("logb").alias("_b"))
            known = known.join(
                level, (F.col("lang") == F.col("_l")) & F.col("logp").isNull()
                & (F.shiftrightunsigned("key", 16) == F.col("_k")), "left")
            known = known.withColumn("weight", F.col("weight") + F.coalesce("_b", F.lit(0.0)))
            known = known.withColumn("key", _last(size - 1)).drop("_l", "_k", "_b")
    per_gram = known.select("lang", F.col("gram").alias("key"), "logp")
    return (sent.join(per_gram, ["lang", "key"])
            .groupBy("doc_id", "lang", "text_key")
            .agg(F.sum(F.col("n") * F.col("logp")).alias("logp")))


def distinct_texts(docs: DataFrame, copied: int = COPIED) -> DataFrame:
    """Each (lang, text) once; a NULL text is an empty one.

    Up to ``copied`` repeated texts are told by the broadcast list of their hashes, so that only
    they are dealt anew and a text that occurs once stays where it is; beyond that all are. Texts
    that share a hash are compared themselves.
    """
    texts = docs.select("lang", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("_key", F.xxhash64("text"))
    again = saved(keyed.groupBy("lang", "_key").agg(F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"))
    if again.limit(copied + 1).count() > copied:
        return texts.distinct()
    again = F.broadcast(again)
    return keyed.join(again, ["lang", "_key"], "left_anti").drop("_key").unionByName(
        keyed.join(again, ["lang", "_key"], "left_semi").drop("_key").distinct())


def language_key() -> Column:
    """The language with a mark before it; NULL is a language of its own, not the empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))


def score(docs: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """Counted rules and log perplexity (nats a unit) of every document.

    The model is counted over the same documents, each distinct text of a language once. Up to
    ``model_rows`` grams it is broadcast as sorted hash arrays; beyond that the grams of the texts
    are joined with it. Both ways give the same sums.
    """
    bounded_batches(docs.sparkSession)
    docs = columns(docs, doc_id="long", text="string", lang="string").withColumns(
        {"lang": language_key(), "text_key": text_key()})
    table = kneser_ney(count_grams(distinct_texts(docs)))
    if table.limit(model_rows + 1).count() <= model_rows:
        scored = _scored(docs, hash_arrays(table))
    else:
        logp = _logp_by_join(docs, table).withColumnsRenamed(
            {"doc_id": "_d", "lang": "_l", "text_key": "_t"})
        scored = _scored(docs, None).drop("logp").join(
            logp, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("lang") == F.col("_l"))
            & (F.col("text_key") == F.col("_t"))).drop("_d", "_l", "_t")
    words = F.col("n_words")
    return saved(scored.withColumns({
        "log_ppl": F.round(-F.col("logp") / F.col("n_grams"), 4),
        "base_failed": (words < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * words),
    }).drop("logp"))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, middle, spread): median log perplexity, and deviation of a text of one unit.

    Both come from histograms of rounded values over the distinct texts that pass the counted rules,
    so no language is sorted in one task and copies do not move the band.
    """
    def median(values: DataFrame, name: str) -> DataFrame:
        return values.groupBy("lang", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("lang").agg(
            F.expr("percentile(v, 0.5D, n)").alias(name))

    passed = saved(scored.where(~F.col("base_failed")).groupBy("lang", "text_key").agg(
        F.min("log_ppl").alias("log_ppl"), F.min("n_grams").alias("n_grams")))
    middle = few_rows(
        saved(median(passed.withColumn("v", F.col("log_ppl")), "middle")), LANGUAGES)
    away = F.abs(F.col("log_ppl") - F.col("middle")) * F.sqrt("n_grams")
    spread = median(passed.join(middle, "lang").withColumn("v", F.round(away, 2)), "away")
    return middle.join(spread, "lang").select(
        "lang", "middle", (F.col("away") * 1.4826).alias("spread"))


def judge(docs: DataFrame, deviations: float = DEVIATIONS, least: float = LEAST) -> DataFrame:
    """Every document with its counts, ``log_ppl``, its band, ``base_failed`` and ``kept``."""
    scored = score(docs)
    side = F.greatest(F.lit(least), deviations * F.col("spread") / F.sqrt("n_grams"))
    judged = scored.join(few_rows(saved(bands(scored)), LANGUAGES), "lang", "left").withColumns(
        {"low": F.col("middle") - side, "high": F.col("middle") + side})
    inside = F.col("log_ppl").between(F.col("low"), F.col("high"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop(
        "middle", "spread")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the counted rules and the bands keep, with all their columns."""
    keyed = docs.withColumn("_language", language_key())
    kept = judge(docs).where("kept").withColumnRenamed("lang", "_language")
    return keep_rows(keyed, kept, "_language").drop("_language")
