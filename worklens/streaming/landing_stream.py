"""Incremental landing: new pages go through a file stream, the high-water marks move last.

A run that fails anywhere repeats its window: the stream's checkpoint replays the unfinished batch
into the same folder, and the marks of the failed run were never written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.schemas import CHANGE_COLUMN, RESOURCES
from worklens.session import shared_folder
from worklens.sources.control import append_run, read_log
from worklens.sources.landing import (
    CORRUPT,
    envelope,
    parsed,
    parsed_pages,
    parsed_records,
    parsed_schema,
)
from worklens.sources.watermark import changes, run_log, watermarks

LANDED = [name for name in RESOURCES if name != "meta"]

MARKS = "recurso string, marca timestamp"
RUNS = ("recurso string, _execucao string, paginas bigint, registros bigint, desde timestamp, "
        "modo string")


def land_new_pages(
    spark: SparkSession, root: str, resource: str, target: str, checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Append the records of pages not seen before, one folder per batch, then return.

    Writing a batch replaces its own folder only, so a replay leaves no duplicate. Inside it each run
    and the unreadable pages have partitions of their own, so a run can be read without the others.
    """
    folder = f"{target}/{resource}"

    def write_batch(pages: DataFrame, batch: int) -> None:
        parsed(pages).write.mode("overwrite").partitionBy("_execucao", "ilegivel").parquet(
            f"{folder}/lote={batch}")

    pages = (
        spark.readStream.schema(f"{envelope(resource)}, {CORRUPT} string, data_carga date")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(f"{root}/{resource}")
        .withColumn("_arquivo", F.col("_metadata.file_path"))
    )
    (
        pages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{checkpoint}/{resource}")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stored(spark: SparkSession, target: str, resource: str) -> DataFrame:
    """Everything parsed so far, as :func:`worklens.sources.landing.parsed` gives it."""
    schema = f"{parsed_schema(resource)}, lote bigint"
    return spark.read.schema(schema).parquet(f"{target}/{resource}").drop("lote")


def stored_run(spark: SparkSession, target: str, resource: str, run: str) -> DataFrame:
    """What one run brought; the files of other runs are not opened."""
    return stored(spark, target, resource).where(F.col("_execucao") == run)


def committed_runs(spark: SparkSession, target: str) -> DataFrame | None:
    """``_execucao`` of the runs whose marks were written, None before the first.

    A snapshot of any other run may be partial and must not delete anything.
    """
    marks = read_log(spark, f"{target}/_controle/marcas", MARKS)
    if marks is None:
        return None
    return marks.select(F.col("execucao").alias("_execucao")).distinct()


def logged_runs(spark: SparkSession, target: str) -> DataFrame | None:
    """The run log so far: pages, records, mode and window per run and resource."""
    return read_log(spark, f"{target}/_controle/execucoes", RUNS)


def landed(spark: SparkSession, target: str, resource: str) -> DataFrame:
    """Records landed so far; repeated ones are settled by the silver versions."""
    return parsed_records(stored(spark, target, resource))


def saved_marks(spark: SparkSession, target: str) -> DataFrame | None:
    """Marks of the newest committed run, None before the first."""
    runs = read_log(spark, f"{target}/_controle/marcas", MARKS)
    if runs is None:
        return None
    newest = runs.agg(F.max("execucao")).scalar()
    return runs.where(F.col("execucao") == newest).select("recurso", "marca")


def log_run(spark: SparkSession, target: str, run: str) -> DataFrame:
    """Write what a run landed: mode, pages, records and window start per resource."""
    pages = [
        parsed_pages(stored_run(spark, target, name, run), name) for name in LANDED
    ]
    landed_pages = reduce(DataFrame.unionByName, pages)
    marks = saved_marks(spark, target)
    if marks is not None:
        marks = marks.withColumn("_execucao", F.lit(run))
    log = run_log(landed_pages, marks)
    return append_run(spark, f"{target}/_controle/execucoes", run, log, RUNS)


def commit_marks(spark: SparkSession, target: str, run: str) -> DataFrame:
    """Write this run's marks next to the earlier ones. Call only after every resource landed.

    Only the run's own records are read; the marks of earlier runs stand for theirs.
    """
    resources = {
        name: parsed_records(stored_run(spark, target, name, run)) for name in CHANGE_COLUMN}
    marks = watermarks(changes(resources), saved_marks(spark, target))
    return append_run(spark, f"{target}/_controle/marcas", run, marks, MARKS)


def land_run(
    spark: SparkSession, root: str, target: str, run: str, checkpoint: str | None = None
) -> DataFrame:
    """Land every resource, log the run, then move the marks; returns the marks of this run."""
    state = f"{checkpoint or shared_folder(spark)}/landing"
    for resource in LANDED:
        land_new_pages(spark, root, resource, target, state)
    log_run(spark, target, run)
    return commit_marks(spark, target, run)
