"""High-water marks for incremental loads and the run log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.functions.times import instant
from worklens.schemas import CHANGE_COLUMN

OVERLAP = "INTERVAL 5 MINUTES"


def changes(resources: Mapping[str, DataFrame]) -> DataFrame:
    """``recurso, alterado_em`` of every record of the incremental resources."""
    parts = [
        df.select(F.lit(name).alias("recurso"), instant(CHANGE_COLUMN[name]).alias("alterado_em"))
        for name, df in resources.items() if name in CHANGE_COLUMN
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def watermarks(changed: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Highest change time seen per resource; a run without changes keeps the earlier mark."""
    marks = changed.groupBy("recurso").agg(F.max("alterado_em").alias("marca"))
    if previous is None:
        return marks
    return (
        marks.unionByName(previous.select("recurso", "marca"))
        .groupBy("recurso").agg(F.max("marca").alias("marca"))
    )


def window_start(marks: DataFrame, overlap: str = OVERLAP) -> DataFrame:
    """From when the next load asks for changes: a little before the mark."""
    return marks.withColumn("desde", F.col("marca") - F.expr(overlap))


def changed_since(
    records: DataFrame, resource: str, column: str, marks: DataFrame | None,
    overlap: str = OVERLAP,
) -> DataFrame:
    """Records strictly newer than the window start; everything without a mark for the resource.

    A record without a time is always kept: nothing says it is old. The mark is read first (one
    value), so that the comparison is a plain filter that reaches the scan.
    """
    if marks is None:
        return records
    start = window_start(marks.where(F.col("recurso") == resource), overlap).agg(F.max("desde"))
    since = start.first()[0]
    if since is None:
        return records
    return records.where((F.col(column) > F.lit(since)) | F.col(column).isNull())


def run_log(pages: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Per resource and run: load mode, pages, records, and the window it asked for.

    ``pages`` holds ``recurso, _execucao, _arquivo, registros``.
    """
    log = pages.groupBy("recurso", "_execucao").agg(
        F.count_distinct("_arquivo").alias("paginas"),
        F.coalesce(F.sum("registros"), F.lit(0)).alias("registros"),
    )
    if marks is None:
        return log.withColumn("modo", F.lit("completo")).withColumn(
            "desde", F.lit(None).cast("timestamp")
        )
    since = window_start(marks).select("recurso", "_execucao", "desde")
    return log.join(since, ["recurso", "_execucao"], "left").withColumn(
        "modo", F.when(F.col("desde").isNull(), "completo").otherwise("incremental")
    )
