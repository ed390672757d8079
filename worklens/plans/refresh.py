"""Full refresh: landed pages to saved silver and gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.operators.quarantine import REASON, all_rejects, cascade
from worklens.operators.skew import HOT_ROWS
from worklens.plans.checks import ROW_CHECKS, require_consistent, row_metrics
from worklens.plans.gold import open_model, star
from worklens.plans.silver import PARSED, candidates, unparsed
from worklens.schemas import RESOURCES, TIME_ZONE
from worklens.session import tune
from worklens.sources.landing import (
    latest_meta,
    parsed,
    parsed_records,
    parsed_rejects,
    read_pages,
)
from worklens.sources.tables import save_table


def refresh_silver(
    spark: SparkSession, root: str, fmt: str = "parquet", hot_rows: int = HOT_ROWS
) -> dict[str, int]:
    """Clean, check and save every landed resource; returns rows per table.

    Pages are parsed once, into a table of records.
    """
    tune(spark)
    counts: dict[str, int] = {}
    stored: dict[str, DataFrame] = {}
    for name in (r for r in RESOURCES if r != "meta"):
        table = f"registros_{name}"
        pages = parsed(read_pages(spark, root, name))
        counts[table] = save_table(pages, table, fmt, ("ilegivel",))
        stored[name] = spark.table(table)
    meta = latest_meta(read_pages(spark, root, "meta"))
    return {**counts, **silver_from_records(spark, stored, meta, fmt, hot_rows)}


def silver_from_records(
    spark: SparkSession, stored: Mapping[str, DataFrame], meta: DataFrame, fmt: str = "parquet",
    hot_rows: int = HOT_ROWS, committed: DataFrame | None = None,
) -> dict[str, int]:
    """The same from records already parsed, such as those an incremental run landed.

    ``committed`` lists the runs whose snapshots are whole. Texts of times that could not be read
    are counted by table and column in ``silver_nao_lidos``.

    Each resource is computed once: its flagged rows are written, valid and rejected ones in
    separate partitions. The silver table is a view over the valid partition, the rejects come from
    the other, and children check their keys against the table just written.
    """
    counts: dict[str, int] = {}
    landed = {name: parsed_records(df) for name, df in stored.items()}

    def write_flagged(name: str, flagged: DataFrame) -> DataFrame:
        table = f"conferido_{name}"
        counts[table] = save_table(
            flagged.withColumn("rejeitado", F.col(REASON).isNotNull()), table, fmt, ("rejeitado",)
        )
        columns = ", ".join(c for c in flagged.columns if c != REASON)
        spark.sql(
            f"CREATE OR REPLACE VIEW silver_{name} AS SELECT {columns} FROM {table} "
            "WHERE NOT rejeitado"
        )
        return spark.table(table).select(*flagged.columns)

    flagged = cascade(
        candidates(landed, committed), stage=write_flagged, hot_rows=hot_rows, sources=landed)
    rejected = all_rejects(flagged)
    for name, df in stored.items():
        rejected = rejected.unionByName(parsed_rejects(df, name))
    counts["silver_rejeitados"] = save_table(
        rejected.withColumn("processado_em", F.current_timestamp()), "silver_rejeitados", fmt
    )
    counts["silver_meta"] = save_table(meta, "silver_meta", fmt)
    failed = [unparsed(landed[name], name) for name in PARSED]
    counts["silver_nao_lidos"] = save_table(
        reduce(DataFrame.unionByName, failed).where("falhas > 0"), "silver_nao_lidos", fmt)
    return counts


def refresh_gold(
    spark: SparkSession, fmt: str = "parquet", zone: str = TIME_ZONE, hot_rows: int = HOT_ROWS
) -> dict[str, int]:
    """Build and save the star schema from the silver tables, then check it.

    Rules on single task rows are counted by the write: tasks that break one are never shown. The
    checks across tables read their keys once, after all of them are saved.
    """
    tune(spark)
    names = ("portfolios", "usuarios", "projetos", "tarefas", "movimentacoes")
    silver = {name: spark.table(f"silver_{name}") for name in names}
    ref = spark.table("silver_meta").agg(F.max("data_referencia")).scalar()
    counts: dict[str, int] = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        held = row_metrics() if name == "fato_tarefa" else None
        counts[name] = save_table(df, name, fmt, violations=held)
        return spark.table(name)

    model = star(spark, silver, ref, zone, hot_rows, stage=save)
    for name in model.names:
        _ = model[name]  # building a table saves it
    require_consistent(open_model(spark), observed=ROW_CHECKS)
    return counts


def refresh(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, int]:
    return {**refresh_silver(spark, root, fmt), **refresh_gold(spark, fmt)}
