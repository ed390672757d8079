"""Landed JSON pages: an envelope with an array of records and the run that wrote it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.operators.latest import newest_row
from worklens.schemas import RESOURCES

CORRUPT = "_corrupt_record"


def envelope(resource: str) -> str:
    """Schema of one page; fields it does not name are dropped, missing ones are NULL."""
    return f"dados array<struct<{_fields(resource)}>>, _execucao string"


def _fields(resource: str) -> str:
    return ", ".join(
        "{}: {}".format(*field.split(" ", 1)) for field in RESOURCES[resource].split(", ")
    )


def read_pages(spark: SparkSession, root: str, resource: str, since: str | None = None) -> DataFrame:
    """Pages of one resource with file lineage, pruned to load dates from ``since`` on.

    ``data_carga`` stays a partition column, so older folders are never opened.
    """
    schema = RESOURCES[resource] if resource == "meta" else envelope(resource)
    pages = (
        spark.read.schema(f"{schema}, {CORRUPT} string, data_carga date")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .json(f"{root.rstrip('/')}/{resource}")
        .withColumn("_arquivo", F.col("_metadata.file_path"))
    )
    return pages if since is None else pages.where(F.col("data_carga") >= F.lit(since).cast("date"))


def parse_pages(lines: DataFrame, text: str, resource: str) -> DataFrame:
    """Pages held as JSON text in a column, under the same fixed schema."""
    options = {"mode": "PERMISSIVE"}
    return lines.select(F.from_json(text, envelope(resource), options).alias("p")).select("p.*")


def records(pages: DataFrame) -> DataFrame:
    """One row per record, with its run. Unreadable pages are reported by :func:`bad_pages`."""
    return pages.select(F.explode("dados").alias("r"), "_execucao").select("r.*", "_execucao")


def bad_pages(pages: DataFrame, resource: str) -> DataFrame:
    """Pages that hold no records array, as rejects, instead of vanishing in the explode."""
    return _page_rejects(pages.where(F.col("dados").isNull()), resource)


def _page_rejects(pages: DataFrame, resource: str) -> DataFrame:
    return pages.select(
        F.lit(resource).alias("tabela"),
        F.col("_arquivo").alias("id"),
        F.lit("página ilegível").alias("motivo"),
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct("_execucao"))).alias("registro"),
    )


def parsed(pages: DataFrame) -> DataFrame:
    """Records, unreadable and empty pages of one parse, to be written once and read as either.

    A page without records leaves one row marked ``vazia``, so that the run log knows of it.
    """
    readable = F.col("dados").isNotNull()
    return pages.select(
        F.explode_outer("dados").alias("r"), "_execucao", (~readable).alias("ilegivel"),
        (readable & (F.size("dados") == 0)).alias("vazia"), "_arquivo", CORRUPT,
    ).where(F.col("r").isNotNull() | F.col("ilegivel") | F.col("vazia")).select(
        "r.*", "_execucao", "ilegivel", "vazia", "_arquivo", CORRUPT)


def parsed_schema(resource: str) -> str:
    """Columns of :func:`parsed` for one resource."""
    return (
        f"{RESOURCES[resource]}, _execucao string, ilegivel boolean, vazia boolean, "
        f"_arquivo string, {CORRUPT} string"
    )


def parsed_records(stored: DataFrame) -> DataFrame:
    return stored.where(~F.col("ilegivel") & ~F.col("vazia")).drop(
        "ilegivel", "vazia", "_arquivo", CORRUPT)


def parsed_rejects(stored: DataFrame, resource: str) -> DataFrame:
    return _page_rejects(stored.where("ilegivel"), resource)


def parsed_pages(stored: DataFrame, resource: str) -> DataFrame:
    """``recurso, _execucao, _arquivo, registros`` of every readable page, empty ones too."""
    return stored.where(~F.col("ilegivel")).groupBy(
        F.lit(resource).alias("recurso"), "_execucao", "_arquivo"
    ).agg(F.count_if(~F.col("vazia")).alias("registros"))


def file_counts(files: DataFrame) -> DataFrame:
    """``_arquivo, registros`` of rows read from a file, by the file's name whatever it is."""
    return files.groupBy("_arquivo").agg(F.count(F.lit(1)).alias("registros"))


def lineage_check(read: DataFrame, logged: DataFrame) -> DataFrame:
    """Files as read against files as logged, both ``_arquivo, registros``, in both directions.

    A file without a log row, a log row without a file, and a file whose number of records differs
    do not agree; several log rows of one file add up.
    """
    log = logged.groupBy("_arquivo").agg(F.sum("registros").alias("registros_log"))
    found = read.groupBy("_arquivo").agg(F.sum("registros").alias("registros_lidos"))
    return found.join(log, "_arquivo", "full").withColumn(
        "situacao",
        F.when(F.col("registros_log").isNull(), "sem registro no log")
        .when(F.col("registros_lidos").isNull(), "sem arquivo")
        .when(F.col("registros_log") == F.col("registros_lidos"), "confere")
        .otherwise("registros diferem"))


def latest_meta(pages: DataFrame) -> DataFrame:
    """The reference date of the newest run, by file path."""
    return newest_row(pages, "_arquivo").select(
        F.try_to_date("data_referencia").alias("data_referencia"),
        "versao",
        "semente",
        F.current_timestamp().alias("processado_em"),
    )
