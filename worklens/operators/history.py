"""Stage visits and their rollup per task."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.functions.labels import stage_order
from worklens.functions.times import days_between, end_of_day, hundredths, local, seconds_between
from worklens.operators.skew import HOT_ROWS, ordered_history
from worklens.schemas import FINAL_STAGES, TIME_ZONE


def stage_visits(
    moves: DataFrame, ref: Column | date, zone: str = TIME_ZONE, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """One row per move, as a stay in the stage it entered.

    Lasts until the next move or, when current, to the end of the reference day; final stages last
    nothing. Durations are taken on instants, so clock changes do not bend them. Without a recorded
    previous stage it is read from the move before, in the same pass.
    """
    derive = "etapa_anterior" not in moves.columns
    ordered = ordered_history(
        moves, "tarefa_id", ["ocorrido_em", "id"],
        number="sequencia",
        following={"_exit": "ocorrido_em"},
        preceding={"etapa_anterior": "etapa_nova"} if derive else None,
        hot_rows=hot_rows,
    )
    final = F.col("etapa_nova").isin(FINAL_STAGES)
    stay_end = F.coalesce(F.col("_exit"), end_of_day(ref, zone))
    entered = local("ocorrido_em", zone)
    return ordered.select(
        F.col("id").alias("passagem_id"),
        "tarefa_id",
        F.col("sequencia").cast("int").alias("sequencia"),
        F.col("etapa_anterior").alias("status_anterior"),
        F.col("etapa_nova").alias("status"),
        stage_order("etapa_nova").alias("ordem_etapa"),
        F.col("usuario_id").alias("pessoa_id"),
        entered.alias("entrada_em"),
        local("_exit", zone).alias("saida_em"),
        F.to_date(entered).alias("data_entrada"),
        F.when(~final, days_between("ocorrido_em", stay_end)).alias("dias_na_etapa"),
        F.when(~final, seconds_between("ocorrido_em", stay_end)).alias("segundos_na_etapa"),
        F.col("_exit").isNull().alias("etapa_atual"),
        final.alias("etapa_final"),
        F.col("ocorrido_em").alias("entrada_utc"),
    )


def history_rollup(visits: DataFrame) -> DataFrame:
    """Per task: first start, blocks, blocked days, rework and last change, in one aggregation.

    Blocked time adds the two-decimal days of each stay as whole hundredths, so the total does not
    depend on the order rows arrive in.
    """
    status = F.col("status")
    blocked = status == "Impedido"
    rework = (F.col("status_anterior") == "Em revisão") & (status == "Fazendo")
    return visits.groupBy("tarefa_id").agg(
        F.min(F.when(status == "Fazendo", F.col("entrada_utc"))).alias("inicio_execucao_utc"),
        F.count_if(blocked).alias("qtd_bloqueios"),
        F.coalesce(F.sum(F.when(blocked, hundredths(F.col("segundos_na_etapa")))), F.lit(0))
        .alias("centesimos_bloqueada"),
        F.count_if(rework).alias("qtd_retrabalho"),
        F.max("entrada_utc").alias("ultima_mudanca_utc"),
        F.count(F.lit(1)).alias("qtd_passagens"),
    )


def no_history(spark: SparkSession) -> DataFrame:
    """The rollup of tasks that carry no moves: no rows."""
    return spark.createDataFrame(
        [], "tarefa_id string, inicio_execucao_utc timestamp, qtd_bloqueios bigint, "
        "centesimos_bloqueada bigint, qtd_retrabalho bigint, ultima_mudanca_utc timestamp, "
        "qtd_passagens bigint")
