"""Entities laid out on calendar months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.functions.times import column


def months_covered(
    df: DataFrame, start: Column | str, end: Column | str,
    first: Column | date, last: Column | date, month: str = "mes_inicio",
) -> DataFrame:
    """One row per calendar month that the span touches, between two bounds.

    The months come from the span itself, so a month table joins by equality and no entity is ever
    compared with every month. A span without a start or an end covers nothing.
    """
    low = F.greatest(F.trunc(column(start), "month"), F.trunc(column(first), "month"))
    high = F.least(F.trunc(column(end), "month"), F.trunc(column(last), "month"))
    known = column(start).isNotNull() & column(end).isNotNull()
    steps = F.when(known & (low <= high), F.sequence(low, high, F.expr("INTERVAL 1 MONTH")))
    return df.withColumn(month, F.explode(steps))


def project_end(
    status: Column | str, done: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    """Where a project's bar stops: done date, the deadline if archived, else deadline or today."""
    return (
        F.when(column(done).isNotNull(), column(done))
        .when(column(status) == "Arquivado", column(deadline))
        .otherwise(F.greatest(column(deadline), column(ref)))
    )


# --- fixed values: bar colours -----------------------------------------------------------------
LATE, ARCHIVED, DONE = "#E44A5D", "#364259", "#5D7398"
ON_HOLD, BLOCKED, ACTIVE = "#33415E", "#C4851A", "#4682F5"


def project_colour(status: Column | str, deadline_state: Column | str) -> Column:
    return (
        F.when(column(deadline_state) == "Atrasado", LATE)
        .when(column(status) == "Arquivado", ARCHIVED)
        .when(column(status) == "Concluído", DONE)
        .when(column(status) == "Em espera", ON_HOLD)
        .otherwise(ACTIVE)
    )


def task_colour(status: Column | str, deadline_state: Column | str) -> Column:
    return (
        F.when(column(status) == "Concluído", DONE)
        .when(column(status) == "Arquivada", ARCHIVED)
        .when(column(status) == "Impedido", BLOCKED)
        .when(column(deadline_state) == "Vencida", LATE)
        .otherwise(ACTIVE)
    )


def project_bars(projects: DataFrame, ref: Column | date) -> DataFrame:
    """Where each project's bar starts and stops, and its colour."""
    return projects.select(
        "projeto_id", "projeto",
        F.col("data_inicio").alias("inicio"),
        project_end("status", "data_conclusao", "data_limite", ref).alias("fim"),
        project_colour("status", "situacao_prazo").alias("cor"),
    )


def task_bars(tasks: DataFrame, ref: Column | date) -> DataFrame:
    """The same for tasks. Rows are titles within a project, so equal titles merge first.

    Dates are those of the whole history, whatever months are shown.
    """
    return tasks.groupBy("projeto_id", "titulo").agg(
        F.min("data_criacao").alias("inicio"),
        F.coalesce(F.max("data_conclusao"), column(ref)).alias("fim"),
        F.max("status").alias("_status"),
        F.max("situacao_prazo").alias("_state"),
    ).select("projeto_id", "titulo", "inicio", "fim", task_colour("_status", "_state").alias("cor"))


def project_months(
    projects: DataFrame, first: Column | date, last: Column | date, ref: Column | date
) -> DataFrame:
    """Project rows of the schedule: one per month the bar touches."""
    return months_covered(project_bars(projects, ref), "inicio", "fim", first, last).select(
        "projeto_id", "projeto", "mes_inicio", "cor"
    )


def task_months(
    tasks: DataFrame, first: Column | date, last: Column | date, ref: Column | date
) -> DataFrame:
    """Task rows of the schedule: one per month the bar touches."""
    return months_covered(task_bars(tasks, ref), "inicio", "fim", first, last).select(
        "projeto_id", "titulo", "mes_inicio", "cor"
    )
