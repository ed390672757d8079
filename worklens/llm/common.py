"""What the operators share: saved results, columns by name, bounded slices of Arrow batches."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Bytes of text handled at once inside a task; one longer text makes a slice of its own.
SLICE_BYTES = 2_000_000


#: Rows and bytes of an Arrow batch: what a task holds at once besides its slice, whatever the texts.
BATCH_ROWS, BATCH_BYTES = 2000, 16_000_000


def bounded_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches; called by every operator that sends texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run on this machine (a local master) a temporary one is
    made; on a cluster a folder of one machine would be an error that shows late, so it shows here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="worklens-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a checkpoint in the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to their types; a missing one is NULL. Others are left behind."""
    return df.select(*(
        (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in types.items()
    ))


def row_key(*names: str) -> Column:
    """64-bit hash by which rows are dealt and ordered, the same at every run."""
    return F.xxhash64(*(F.col(n) for n in names))


#: Hashes that samples are drawn by lie below this.
_HASHES = 1 << 40


def _hash(keys) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k) for k in keys)), F.lit(_HASHES))


def _distinct(keys) -> Column:
    """About how many different keys there are: repeats must not narrow the share a filter leaves."""
    return F.approx_count_distinct(F.xxhash64(*(F.col(k) for k in keys)), 0.02)


def hash_sample(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, those of the smallest hash of ``keys``; ``keys`` do not repeat.

    A filter on the hash leaves about twice as many first, so what is sorted does not grow with the
    table, nor with the number of tasks.
    """
    rows = df.agg(_distinct(keys).alias("n")).first()["n"]
    share = min(_HASHES, 2 * size * _HASHES // max(1, rows))
    return df.where(_hash(keys) < share).orderBy(_hash(keys), *keys).limit(size)


def hash_sample_by(df: DataFrame, group: str, size: int, *keys: str) -> DataFrame:
    """The same for each value of ``group``; rows equal in group and keys count once.

    The driver holds one count a group: only for columns of few values, such as languages.
    """
    counts = df.groupBy(group).agg(_distinct(keys).alias("n")).collect()
    if not counts:
        return df
    shares = [x for r in counts for x in (
        F.lit(r[0]), F.lit(min(_HASHES, 2 * size * _HASHES // max(1, r["n"]))))]
    few = df.where(_hash(keys) < F.create_map(*shares)[F.col(group)])
    rest = [c for c in df.columns if c != group and c not in keys]
    few = few.groupBy(group, *keys).agg(*(F.first(c).alias(c) for c in rest)) if rest else (
        few.distinct())
    rank = Window.partitionBy(group).orderBy(_hash(keys), *keys)
    return few.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= size).drop(
        "_rank")


def few_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (saved) to be broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer text."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def keep_rows(df: DataFrame, decided: DataFrame, *same: str) -> DataFrame:
    """Rows of ``df`` whose (doc_id, text) and columns ``same`` are among ``decided``; NULLs match and
    repeats stay.

    ``decided`` has ``doc_id`` and ``text_key`` (:func:`text_key`), a few bytes a row: no id or text
    goes through the driver, and two rows that share an id but not the text are told apart.
    """
    keys = decided.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                          *(F.col(c).alias(f"_same_{c}") for c in same)).distinct()
    matched = F.col("doc_id").eqNullSafe(F.col("_id")) & text_key().eqNullSafe(F.col("_key"))
    for c in same:
        matched = matched & F.col(c).eqNullSafe(F.col(f"_same_{c}"))
    return df.join(keys, matched, "left_semi")


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())
