"""State of work items as of a date, and project attributes derived from their tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.operators.skew import skew_join


def state_as_of(moves: DataFrame, cut: Column) -> DataFrame:
    """Each task as its events up to ``cut`` leave it; tasks created later do not exist yet."""
    position = F.struct("ocorrido_em", "id")
    return (
        moves.where(F.col("ocorrido_em") <= cut)
        .groupBy("tarefa_id")
        .agg(
            F.max_by("etapa_nova", position).alias("status"),
            F.min("ocorrido_em").alias("criada_em"),
            F.max("ocorrido_em").alias("atualizado_em"),
            F.count(F.lit(1)).alias("qtd_passagens"),
        )
    )


def cut_differences(earlier: DataFrame, later: DataFrame, cut: Column) -> DataFrame:
    """What moving the clock broke: tasks lost, or changed without a later update.

    Empty when the past is stable.
    """
    after = later.select(
        "tarefa_id",
        F.col("status").alias("_status"),
        F.col("criada_em").alias("_criada"),
        F.col("atualizado_em").alias("_atualizado"),
    )
    changed = (F.col("status") != F.col("_status")) | (
        F.col("atualizado_em") != F.col("_atualizado")
    )
    problem = (
        F.when(F.col("_status").isNull(), "tarefa sumiu")
        .when(F.col("criada_em") != F.col("_criada"), "criação mudou")
        .when(changed & (F.col("_atualizado") <= cut), "mudou sem atualização posterior")
    )
    return (
        earlier.join(after, "tarefa_id", "left")
        .select("tarefa_id", problem.alias("problema"))
        .where(F.col("problema").isNotNull())
    )


def history_labels(moves: DataFrame) -> DataFrame:
    """Labels a task's history earns: blocked now, reworked ever."""
    position = F.struct("ocorrido_em", "id")
    rework = (F.col("etapa_anterior") == "Em revisão") & (F.col("etapa_nova") == "Fazendo")
    facts = moves.groupBy("tarefa_id").agg(
        F.max_by("etapa_nova", position).alias("_now"),
        F.coalesce(F.bool_or(rework), F.lit(False)).alias("_rework"),
    )
    labels = F.array_compact(F.array(
        F.when(F.col("_now") == "Impedido", F.lit("Bloqueada")),
        F.when(F.col("_rework"), F.lit("Retrabalho")),
    ))
    return facts.select("tarefa_id", labels.alias("etiquetas"))


def task_progress(tasks: DataFrame) -> DataFrame:
    """Per project: tasks, share done, and which kinds of stage they are in."""
    stage = F.col("etapa")
    return tasks.groupBy("projeto_id").agg(
        F.count(F.lit(1)).alias("qtd_tarefas"),
        F.count_if(stage == "Concluído").alias("qtd_concluidas"),
        F.avg((stage == "Concluído").cast("int")).alias("parte_concluida"),
        F.bool_and(stage.isin("Backlog", "A fazer")).alias("nada_iniciado"),
        F.bool_and(stage.isin("Concluído", "Arquivada")).alias("tudo_encerrado"),
        F.max("atualizado_em").alias("ultima_mudanca"),
    )


def project_stage(
    stopped: Column, cancelled: Column, closes: Column, progress_ref: Column
) -> tuple[Column, Column]:
    """``situacao, etapa`` of a project from its stop decision and the progress of its tasks.

    Expects the columns of :func:`task_progress`, NULL for a project without tasks. ``closes`` is
    when the scope closes, ``progress_ref`` the moment it is judged at.
    """
    idle = F.coalesce(F.col("nada_iniciado"), F.lit(True))
    finished = F.coalesce(F.col("tudo_encerrado"), F.lit(False)) & (closes <= progress_ref)
    state = (
        F.when(stopped, F.when(cancelled, "Arquivado").otherwise("Ativo"))
        .when(idle, "Ativo")
        .when(finished, "Concluído")
        .otherwise("Ativo")
    )
    stage = (
        F.when(stopped, "Execução")
        .when(idle, "Planejamento")
        .when(finished, "Concluído")
        .when(F.col("parte_concluida") >= 0.8, "Implantação")
        .otherwise("Execução")
    )
    return state, stage


def budget_rollup(
    tasks: DataFrame, scope_end: DataFrame, rates: DataFrame
) -> DataFrame:
    """Hours of the tasks created within the original scope, plus 10 %, up to the next ten.

    ``scope_end`` is one row per project: ``projeto_id, portfolio_id, escopo_ate``; ``rates`` holds
    the hourly cost per portfolio. A project without such tasks has a budget of zero.
    """
    created = tasks.select("projeto_id", "criada_em", "estimativa_horas")
    limits = scope_end.select("projeto_id", "escopo_ate")
    inside = (
        skew_join(created, limits, "projeto_id", "inner", ["criada_em", "estimativa_horas"])
        .where(F.col("criada_em") <= F.col("escopo_ate"))
        .groupBy("projeto_id").agg(F.sum("estimativa_horas").alias("_sum"))
    )
    hours = scope_end.join(inside, "projeto_id", "left").select(
        "projeto_id", "portfolio_id", F.coalesce("_sum", F.lit(0.0)).alias("_hours"))
    budget = (F.ceil(F.col("_hours") * 1.1 / 10) * 10).cast("int")
    return hours.join(rates, "portfolio_id", "left").select(
        "projeto_id",
        "portfolio_id",
        budget.alias("horas_orcadas"),
        (budget * F.col("custo_hora")).cast("double").alias("orcamento"),
    )

