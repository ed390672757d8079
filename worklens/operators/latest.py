"""Current versions: newest snapshot, newest version per key, newest row of all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_snapshot(
    df: DataFrame, run: str = "_execucao", committed: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest run only, so a record missing from it has been deleted at the source.

    ``committed`` optionally lists finished runs (one column named ``run``), to skip a partial one.
    """
    if committed is not None:
        df = df.join(committed.select(run).distinct(), run, "left_semi")
    newest = df.agg(F.max(run)).scalar()
    return df.where(F.col(run) == newest)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, first by ``order``; equal versions are settled by the other columns.

    The rank filter is planned as a per-task limit before the shuffle, so a key with very many
    versions sends one row per map task, not its whole group.
    """
    rest = [c for c in df.columns if c not in keys] if ties is None else list(ties)
    window = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).desc() for c in rest])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def newest_row(df: DataFrame, by: str) -> DataFrame:
    """The single newest row, as a top-1 rather than a full sort."""
    return df.orderBy(F.col(by).desc()).limit(1)
