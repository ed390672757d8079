"""Silver: one clean, typed row per record of each resource."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.functions.text import capitalised, empty_labels, in_domain, squeeze
from worklens.functions.times import day, instant
from worklens.operators.latest import latest_per_key, latest_snapshot
from worklens.schemas import CHANGE_COLUMN, PRIORITIES, PRIORITY_UNKNOWN

RUN = "_execucao"


def current(
    records: DataFrame, resource: str, committed: DataFrame | None = None
) -> DataFrame:
    """Newest version of each id: by change time, then by run; snapshots keep the last run only.

    ``committed`` lists the finished runs (``_execucao``): the snapshot of a run that broke off may
    be partial, and what it lacks has not been deleted. A move never changes, so its newest run stands whatever its time.
    """
    newest_run = F.col(RUN).desc()
    if resource not in CHANGE_COLUMN:
        return latest_per_key(
            latest_snapshot(records, RUN, committed), ["id"], [newest_run])
    order = [newest_run]
    if resource != "movimentacoes":
        order.insert(0, instant(CHANGE_COLUMN[resource]).desc())
    return latest_per_key(records, ["id"], order)


def portfolios(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        squeeze("nome").alias("nome"),
        F.upper(squeeze("sigla")).alias("sigla"),
        "dono_id",
        "etapas",
    )


def people(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        squeeze("nome").alias("nome"),
        F.lower(squeeze("email")).alias("email"),
        "portfolio_id",
        squeeze("cargo").alias("cargo"),
        day("data_admissao").alias("data_admissao"),
        F.coalesce("ativo", F.lit(True)).alias("ativo"),
    )


def projects(df: DataFrame) -> DataFrame:
    clean = {c: squeeze(c) for c in ("nome", "etapa", "situacao", "origem")}
    days = {c: day(c) for c in ("inicio", "limite", "concluido_em")}
    moments = {c: instant(c) for c in ("criado_em", "atualizado_em")}
    return df.withColumns({
        **clean, **days, **moments,
        "farol": capitalised("farol"),
        "prioridade": in_domain("prioridade", PRIORITIES, PRIORITY_UNKNOWN),
        "etiquetas": empty_labels("etiquetas"),
    }).drop(RUN)


def tasks(df: DataFrame) -> DataFrame:
    clean = {c: squeeze(c) for c in ("titulo", "tipo", "etapa", "situacao")}
    moments = {c: instant(c) for c in ("criada_em", "concluida_em", "atualizado_em")}
    return df.withColumns({
        **clean, **moments,
        "limite": day("limite"),
        "prioridade": in_domain("prioridade", PRIORITIES, PRIORITY_UNKNOWN),
        "etiquetas": empty_labels("etiquetas"),
    }).drop(RUN)


def moves(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "etapa_anterior": squeeze("etapa_anterior"),
        "etapa_nova": squeeze("etapa_nova"),
        "ocorrido_em": instant("ocorrido_em"),
    }).drop(RUN)


# parents before children, the order the quarantine needs
CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "portfolios": portfolios,
    "usuarios": people,
    "projetos": projects,
    "tarefas": tasks,
    "movimentacoes": moves,
}


def candidates(
    landed: Mapping[str, DataFrame], committed: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Clean current rows of every resource, not yet checked."""
    return {
        name: clean(current(landed[name], name, committed)) for name, clean in CLEANERS.items()}


# columns read as time or date, per resource: source text that fails to parse becomes NULL
PARSED = {
    "usuarios": ["data_admissao"],
    "projetos": ["inicio", "limite", "concluido_em", "criado_em", "atualizado_em"],
    "tarefas": ["criada_em", "limite", "concluida_em", "atualizado_em"],
    "movimentacoes": ["ocorrido_em"],
}


def unparsed(landed: DataFrame, resource: str) -> DataFrame:
    """How many texts of each time column could not be read."""
    failed = [
        F.count_if(F.col(c).isNotNull() & instant(c).isNull()).alias(c) for c in PARSED[resource]
    ]
    counts = landed.agg(*failed)
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("falhas")) for c in PARSED[resource]]
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select(
        F.lit(resource).alias("tabela"), "r.*"
    )
