"""Audits over entities and their event history. Each returns ``tabela, id, problema``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.functions.labels import is_done
from worklens.functions.times import column, local
from worklens.operators.quarantine import Rule, outside
from worklens.operators.skew import HOT_ROWS, ordered_history
from worklens.schemas import LIGHTS, PROJECT_STATES, STAGE_NAMES, TIME_ZONE



# fixed values: stages nothing leaves, and the texts of the findings below
FINAL = ["Concluído", "Arquivada"]


def _findings(df: DataFrame, table: str, rules: list[Rule], row_id: str = "id") -> DataFrame:
    """One row per broken rule: unlike the quarantine, a record may have several."""
    problems = F.array_compact(F.array(*[F.when(broken, F.lit(text)) for broken, text in rules]))
    return df.select(
        F.lit(table).alias("tabela"),
        F.col(row_id).cast("string").alias("id"),
        F.explode(problems).alias("problema"),
    )


def duplicates(df: DataFrame, table: str, column_name: str = "id") -> DataFrame:
    """Values that appear more than once where each should be unique."""
    return (
        df.groupBy(F.col(column_name).cast("string").alias("id"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select(
            F.lit(table).alias("tabela"), "id",
            F.lit(f"{column_name} duplicado").alias("problema"))
    )


def history_steps(
    moves: DataFrame, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Problems between consecutive events of a task: a jump, or time not moving forward.

    Events are taken in id order, the order they were issued in, so that a wrong time shows.
    """
    steps = ordered_history(
        moves, "tarefa_id", ["id"],
        preceding={"_stage": "etapa_nova", "_time": "ocorrido_em"}, hot_rows=hot_rows)
    follows = F.col("_time").isNotNull()
    jump = follows & ~F.col("etapa_anterior").eqNullSafe(F.col("_stage"))
    start = ~follows & F.col("etapa_anterior").isNotNull()
    return _findings(steps, "movimentacoes", [
        (jump, "histórico pula etapa"),
        (F.col("ocorrido_em") <= F.col("_time"), "histórico fora de ordem"),
        (start, "histórico não começa na criação"),
    ])


def history_matches_tasks(tasks: DataFrame, moves: DataFrame) -> DataFrame:
    """Tasks whose current stage or dates disagree with their first and last event."""
    ends = moves.groupBy("tarefa_id").agg(
        F.min_by("ocorrido_em", "id").alias("_first"),
        F.max_by("ocorrido_em", "id").alias("_last"),
        F.max_by("etapa_nova", "id").alias("_stage"),
    ).withColumnRenamed("tarefa_id", "id")
    joined = tasks.join(ends, "id", "left")
    known = F.col("_first").isNotNull()
    dates = ~F.col("criada_em").eqNullSafe(F.col("_first")) | ~F.col("atualizado_em").eqNullSafe(
        F.col("_last")
    )
    return _findings(joined, "tarefas", [
        (~known, "sem histórico"),
        (known & ~F.col("etapa").eqNullSafe(F.col("_stage")),
         "status atual difere do último evento"),
        (known & dates, "datas da tarefa não batem com o histórico"),
    ])


def task_coherence(tasks: DataFrame, ref: Column | date, zone: str = TIME_ZONE) -> DataFrame:
    done = F.coalesce(is_done("etapa"), F.lit(False))
    return _findings(tasks, "tarefas", [
        (F.col("etapa").isNull() | outside("etapa", STAGE_NAMES), "status desconhecido"),
        (F.to_date(local("atualizado_em", zone)) > column(ref), "data depois da referência"),
        (F.col("concluida_em").isNotNull() != done,
         "data de conclusão incoerente com o status"),
        # asked of tasks that are still open
        (~F.coalesce(F.col("etapa").isin(FINAL), F.lit(False)) & (F.col("horas_apontadas") < 0),
         "horas negativas"),
    ])


def project_coherence(projects: DataFrame) -> DataFrame:
    done = F.coalesce(F.col("situacao") == "Concluído", F.lit(False))
    unknown = (
        F.col("situacao").isNull() | outside("situacao", PROJECT_STATES)
        | F.col("farol").isNull() | outside("farol", LIGHTS)
    )
    return _findings(projects, "projetos", [
        (F.col("limite") <= F.col("inicio"), "fim planejado antes do início"),
        (F.col("concluido_em").isNotNull() != done,
         "data de conclusão incoerente com o status"),
        (unknown, "situação ou farol desconhecido"),
    ])


def orphans(child: DataFrame, column_name: str, parent: DataFrame, table: str) -> DataFrame:
    """Rows whose key is missing from the parent; a NULL key is missing too."""
    keys = parent.select(F.col("id").alias(column_name))
    return child.join(keys, column_name, "left_anti").select(
        F.lit(table).alias("tabela"),
        F.col("id").cast("string").alias("id"),
        F.lit(f"{column_name} inexistente").alias("problema"),
    )
