"""The report's queries, one function per visual."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.operators.measures import ordered
from worklens.operators.skew import skew_join
from worklens.operators.spans import months_covered, project_bars, task_bars
from worklens.plans.gold import Model
from worklens.plans.measures import measure

Filters = Mapping[str, Sequence] | None
REPORT_YEARS = [2025, 2026]  # fixed value: years the report shows

# fixed values: the cards of the two pages, value and context line
CARDS = {
    "Portfólio": [
        ("Projetos Ativos", "Contexto Projetos de Ideias"),
        ("Projetos Atrasados", "Contexto Projetos Atrasados"),
        ("% Entregues no Prazo", None),
        ("Texto Orçamento", "Contexto Orçamento Consumido"),
    ],
    "Projetos e tarefas": [
        ("Tarefas Abertas", "Contexto Tarefas Abertas"),
        ("Tarefas Vencidas", "Contexto Tarefas Vencidas"),
        ("% Tarefas Concluídas", "Contexto Tarefas Concluídas"),
        ("Lead Time Médio (dias)", None),
    ],
}


def health(model: Model, filters: Filters = None) -> DataFrame:
    """Projects by traffic light, most first."""
    result = measure(model, ["Projetos"], ["dim_projeto.farol"], filters)
    return result.orderBy(F.col("Projetos").desc(), "farol")


def created_delivered(
    model: Model, years: Sequence[int] = REPORT_YEARS, filters: Filters = None
) -> DataFrame:
    """Tasks created and delivered per month, in calendar order."""
    result = measure(
        model, ["Tarefas Criadas", "Tarefas Entregues"], ["dim_data.ano_mes", "dim_data.mes_ano"],
        {**(filters or {}), "dim_data.ano": list(years)},
    )
    return ordered(result, "dim_data.mes_ano")


def sliced(model: Model, filters: Filters) -> Model:
    """The model under slicers on projects, people and tasks: tasks follow the keys of the others.

    A slicer on anything else does not reach these rows and is an error, not ignored.
    """
    own: dict[str, list[Column]] = {"dim_projeto": [], "dim_pessoa": [], "fato_tarefa": []}
    for ref, values in (filters or {}).items():
        table, name = ref.split(".", 1)
        if table not in own:
            raise ValueError(f"a slicer on {ref} does not reach this report")
        own[table].append(F.col(name).isin(list(values)))

    def under(name: str) -> DataFrame:
        df = model[name]
        for condition in own[name]:
            df = df.where(condition)
        return df

    def tasks() -> DataFrame:
        df = under("fato_tarefa")
        for table, key, link in (("dim_projeto", "projeto_id", "projeto_id"),
                                 ("dim_pessoa", "pessoa_id", "responsavel_id")):
            if own[table]:
                keys = under(table).select(F.col(key).alias(link))
                df = df.join(keys, link, "left_semi").select(*df.columns)
        return df

    if not filters:
        return model
    return model.replacing({
        "dim_projeto": lambda: under("dim_projeto"), "dim_pessoa": lambda: under("dim_pessoa"),
        "fato_tarefa": tasks})


def _project_rows(model: Model, filters: Filters) -> DataFrame:
    beyond = [ref for ref in filters or {} if not ref.startswith("dim_projeto.")]
    if beyond:
        raise ValueError(f"slicers on {beyond} do not reach a table of projects")
    return sliced(model, filters)["dim_projeto"]


def at_risk(model: Model, filters: Filters = None) -> DataFrame:
    """Late projects by days late; a table shows each combination once."""
    late = _project_rows(model, filters).where(F.col("situacao_prazo") == "Atrasado")
    return late.select("projeto", "dias_atraso").distinct().orderBy(
        F.col("dias_atraso").desc(), "projeto")


def by_portfolio(model: Model, filters: Filters = None) -> DataFrame:
    names = ["Projetos Ativos", "Projetos Atrasados"]
    result = measure(model, names, ["dim_projeto.portfolio"], filters)
    return result.orderBy(F.col("Projetos Ativos").desc_nulls_last(), "portfolio")


def stage_board(model: Model, filters: Filters = None) -> DataFrame:
    result = measure(model, ["Projetos"], ["dim_projeto.etapa"], filters)
    return result.orderBy(F.col("Projetos").desc(), "etapa")


def project_table(model: Model, filters: Filters = None) -> DataFrame:
    """Projects with the share of their tasks that is done, latest first.

    Tasks are counted per project before the join; projects that show the same values merge, as
    the rows of a table do.
    """
    shown = ["projeto", "portfolio", "etapa", "farol", "dias_atraso"]
    counts = model["fato_tarefa"].groupBy("projeto_id").agg(
        F.count(F.lit(1)).alias("_tasks"), F.count_if(F.col("status") == "Concluído").alias("_done")
    )
    merged = (
        _project_rows(model, filters).join(counts, "projeto_id", "left")
        .groupBy(*shown)
        .agg(F.sum("_tasks").alias("_tasks"), F.sum("_done").alias("_done"))
    )
    share = F.try_divide(F.nullif("_done", F.lit(0)), "_tasks")
    return merged.select(*shown, share.alias("concluido")).orderBy(
        F.col("dias_atraso").desc_nulls_last(), "projeto")


def stalled(model: Model, filters: Filters = None) -> DataFrame:
    """Open tasks per stage of their current visit, in stage order."""
    axis = ["fato_passagem_status.ordem_etapa", "fato_passagem_status.status"]
    result = measure(model, ["Tarefas Paradas na Etapa"], axis, filters)
    return ordered(result, "fato_passagem_status.status")


def overdue(model: Model, filters: Filters = None) -> DataFrame:
    """Overdue tasks with who owns them, latest first."""
    model = sliced(model, filters)
    people = model["dim_pessoa"].select(F.col("pessoa_id").alias("responsavel_id"), "pessoa")
    late = model["fato_tarefa"].where(F.col("situacao_prazo") == "Vencida")
    # people and titles repeat: a table shows each combination once
    shown = late.select("responsavel_id", "titulo", "dias_atraso").distinct()
    return (
        shown.join(people, "responsavel_id", "left")
        .select("titulo", "pessoa", "dias_atraso").distinct()
        .orderBy(F.col("dias_atraso").desc(), "titulo", "pessoa")
    )


def schedule(
    model: Model, ref: Column | date, years: Sequence[int] = REPORT_YEARS,
    filters: Filters = None, counted: DataFrame | None = None,
) -> DataFrame:
    """Schedule in long form: one row per project or task and month, with colour and label.

    Project rows have no title. Bars get their project's name before they spread over months, and
    months carry the calendar's label and order. ``counted`` is a cheaper table with the tasks'
    ``projeto_id``, such as their source, to count hot projects in.
    """
    days, model = model["dim_data"], sliced(model, filters)
    first, last = date(min(years), 1, 1), date(max(years), 12, 31)
    names = model["dim_projeto"].select("projeto_id", "projeto")
    tasks = skew_join(
        task_bars(model["fato_tarefa"], ref), names, "projeto_id", "inner", ["titulo"],
        counted=model["fato_tarefa"] if counted is None else counted)
    projects = project_bars(model["dim_projeto"], ref).withColumn(
        "titulo", F.lit(None).cast("string"))
    cells = months_covered(projects.unionByName(tasks), "inicio", "fim", first, last)
    months = days.where(F.dayofmonth("data") == 1).select(
        F.col("data").alias("mes_inicio"), "ano", "ano_mes", "mes_ano")
    return (
        cells.join(F.broadcast(months), "mes_inicio")  # one row per calendar month
        .where(F.col("ano").isin(list(years)))
        .select("projeto_id", "projeto", "titulo", "ano_mes", "mes_ano", "cor",
                F.lit(" ").alias("cronograma"))
    )


def schedule_matrix(cells: DataFrame, months: Sequence[str]) -> DataFrame:
    """The same as a matrix, one column per listed month; months without a bar are NULL.

    Rows are project names and titles, so projects of one name share a row.
    """
    return cells.groupBy("projeto", "titulo").pivot("mes_ano", list(months)).agg(F.max("cor"))


def cards(model: Model, filters: Filters = None) -> DataFrame:
    """Every card's value and context line, in one row."""
    names = [n for page in CARDS.values() for card in page for n in card if n]
    return measure(model, names, (), filters)


def portfolio_totals(model: Model) -> DataFrame:
    """Projects, tasks and open tasks per portfolio; a portfolio without tasks shows zero.

    Tasks are counted per project first, so projects are not repeated and need no distinct count.
    """
    counts = model["fato_tarefa"].groupBy("projeto_id").agg(
        F.count(F.lit(1)).alias("_tasks"), F.count_if("aberta").alias("_open"))
    return (
        model["dim_projeto"].select("projeto_id", "portfolio").join(counts, "projeto_id", "left")
        .groupBy("portfolio")
        .agg(
            F.count(F.lit(1)).alias("projetos"),
            F.coalesce(F.sum("_tasks"), F.lit(0)).alias("tarefas"),
            F.coalesce(F.sum("_open"), F.lit(0)).alias("abertas"),
        )
    )
