"""Gold: the star schema, measured against the reference date stored in the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.functions.labels import (
    effort_deviation,
    is_done,
    is_open,
    project_days_late,
    project_deadline_state,
    project_status,
    schedule_elapsed,
    task_days_late,
    task_deadline_state,
)
from worklens.functions.text import joined
from worklens.functions.times import column, days_between, end_of_day, local
from worklens.operators.history import history_rollup, stage_visits
from worklens.operators.skew import HOT_ROWS, skew_join
from worklens.schemas import GOLD, TIME_ZONE, gold_schema
from worklens.sources.calendar import calendar, calendar_bounds, stage_catalog


class Model:
    """The tables of the star schema, by name; each plan is built when first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    @property
    def names(self) -> list[str]:
        return list(self._builders)

    def replacing(self, builders: Mapping[str, Callable[[], DataFrame]]) -> Model:
        """The same model with some tables built another way."""
        keep = {name: lambda name=name: self[name] for name in self._builders}
        return Model({**keep, **builders})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the frozen columns of a gold table: names, types and order."""
    return df.to(gold_schema(table))


def task_facts(
    tasks: DataFrame, rollup: DataFrame, ref: Column | date, zone: str = TIME_ZONE
) -> DataFrame:
    """One row per task with its times, effort and deadline state; tasks without moves stay."""
    history = rollup.withColumnRenamed("tarefa_id", "id")
    joined_rows = tasks.join(history, "id", "left")
    created, done = local("criada_em", zone), local("concluida_em", zone)
    today = end_of_day(ref, zone)
    rows = joined_rows.select(
        F.col("id").alias("tarefa_id"),
        "projeto_id", "responsavel_id", "titulo", "tipo", "prioridade",
        F.col("etapa").alias("status"),
        "situacao",
        joined("etiquetas").alias("etiquetas"),
        F.to_date(created).alias("data_criacao"),
        created.alias("criada_em"),
        F.to_date(local("inicio_execucao_utc", zone)).alias("data_inicio_execucao"),
        F.to_date(done).alias("data_conclusao"),
        done.alias("concluida_em"),
        F.col("limite").alias("data_limite"),
        "estimativa_horas", "horas_apontadas",
        effort_deviation("etapa", "horas_apontadas", "estimativa_horas").alias("desvio_horas"),
        is_open("etapa").alias("aberta"),
        F.when(is_done("etapa"), days_between("criada_em", "concluida_em"))
        .alias("lead_time_dias"),
        F.when(is_done("etapa"), days_between("inicio_execucao_utc", "concluida_em"))
        .alias("ciclo_dias"),
        F.when(is_open("etapa"), days_between("criada_em", today)).alias("idade_dias"),
        F.when(is_open("etapa"), days_between("ultima_mudanca_utc", today))
        .alias("dias_na_etapa_atual"),
        F.coalesce("qtd_bloqueios", F.lit(0)).alias("qtd_bloqueios"),
        (F.coalesce("centesimos_bloqueada", F.lit(0)) / F.lit(100.0)).alias("dias_bloqueada"),
        F.coalesce("qtd_retrabalho", F.lit(0)).alias("qtd_retrabalho"),
    )
    judged = ("status", "data_conclusao", "data_limite", ref)
    return conform(
        rows.withColumns({
            "situacao_prazo": task_deadline_state(*judged),
            "dias_atraso": task_days_late(*judged),
        }),
        "fato_tarefa",
    )


def visit_facts(
    visits: DataFrame, tasks: DataFrame, hot_rows: int = HOT_ROWS, moves: DataFrame | None = None
) -> DataFrame:
    """Stage visits of known tasks, with their project; hot tasks may be counted in ``moves``."""
    owner = tasks.select(F.col("id").alias("tarefa_id"), "projeto_id")
    return conform(
        skew_join(visits, owner, "tarefa_id", "inner", ["passagem_id"], hot_rows, moves),
        "fato_passagem_status",
    )


def project_dimension(
    projects: DataFrame, portfolios: DataFrame, people: DataFrame, ref: Column | date
) -> DataFrame:
    names = portfolios.select(F.col("id").alias("portfolio_id"), F.col("nome").alias("portfolio"))
    managers = people.select(F.col("id").alias("gerente_id"), F.col("nome").alias("gerente"))
    rows = (
        projects.join(names, "portfolio_id", "left").join(managers, "gerente_id", "left")
        .withColumnsRenamed({
            "id": "projeto_id", "nome": "projeto", "inicio": "data_inicio",
            "limite": "data_limite", "concluido_em": "data_conclusao",
        })
        .withColumn("status", project_status("situacao", "etiquetas", "etapa"))
    )
    judged = ("status", "data_conclusao", "data_limite", ref)
    return conform(
        rows.withColumns({
            "etiquetas": joined("etiquetas"),
            "dias_planejados": F.datediff("data_limite", "data_inicio"),
            "situacao_prazo": project_deadline_state(*judged),
            "dias_atraso": project_days_late(*judged),
            "percentual_prazo_decorrido":
                schedule_elapsed("status", "data_inicio", "data_limite", ref),
        }),
        "dim_projeto",
    )


def people_dimension(people: DataFrame, portfolios: DataFrame) -> DataFrame:
    names = portfolios.select(F.col("id").alias("portfolio_id"), F.col("nome").alias("portfolio"))
    rows = people.join(names, "portfolio_id", "left").withColumnsRenamed(
        {"id": "pessoa_id", "nome": "pessoa"}
    )
    return conform(rows, "dim_pessoa")


def parameters(spark: SparkSession, ref: Column | date, zone: str = TIME_ZONE) -> DataFrame:
    row = spark.range(1).select(
        column(ref).alias("data_referencia"),
        local(F.current_timestamp(), zone).alias("processado_em"),
    )
    return conform(row, "ref_parametros")


def star(
    spark: SparkSession, silver: Mapping[str, DataFrame], ref: Column | date,
    zone: str = TIME_ZONE, hot_rows: int | None = HOT_ROWS,
    stage: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> Model:
    """All seven tables from valid silver rows. ``ref`` is a date or a scalar from the meta table.

    ``stage`` may save a table and return it read back, so that visits are ordered only once and
    the calendar reads finished tables.
    """
    @cache
    def visits() -> DataFrame:
        return stage("passagens", stage_visits(silver["movimentacoes"], ref, zone, hot_rows))

    builders = {
        "fato_tarefa": lambda: task_facts(
            silver["tarefas"], history_rollup(visits()), ref, zone),
        "fato_passagem_status": lambda: visit_facts(
            visits(), silver["tarefas"], hot_rows or HOT_ROWS, silver["movimentacoes"]),
        "dim_projeto": lambda: project_dimension(
            silver["projetos"], silver["portfolios"], silver["usuarios"], ref),
        "dim_pessoa": lambda: people_dimension(silver["usuarios"], silver["portfolios"]),
        "dim_status": lambda: stage_catalog(spark),
        "dim_data": lambda: calendar_table(model["fato_tarefa"], model["dim_projeto"], ref),
        "ref_parametros": lambda: parameters(spark, ref, zone),
    }
    model = Model({
        name: lambda name=name, build=build: stage(name, build())
        for name, build in builders.items()
    })
    return model


def calendar_table(tasks: DataFrame, projects: DataFrame, ref: Column | date) -> DataFrame:
    return conform(calendar(calendar_bounds(tasks, projects, ref), ref), "dim_data")


def open_model(spark: SparkSession) -> Model:
    """The star schema as saved in the catalog."""
    return Model({name: lambda name=name: spark.table(name) for name in GOLD})
