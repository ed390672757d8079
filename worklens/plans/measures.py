"""The measure catalog: 54 named measures over the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.functions.text import number_br, percent_br, signed_percent_br, whole_br
from worklens.operators.measures import (
    PARAMETERS,
    PROJECT,
    TASK,
    VISIT,
    Atom,
    Context,
    Measure,
    evaluate,
    hundredths_total,
    rows,
    total,
)
from worklens.plans.gold import Model
from worklens.schemas import ROLES

RUNNING = "status IN ('Em execução', 'Planejamento')"
LATE_PROJECT = "situacao_prazo IN ('Atrasado', 'Concluído com atraso')"
LATE_TASK = "situacao_prazo IN ('Vencida', 'Concluída com atraso')"
DONE = "status = 'Concluído'"
STALLED = "etapa_atual AND NOT etapa_final"


def _delay(fact: str, where: str) -> tuple[Atom, Atom]:
    takes = ["situacao_prazo"]
    return (
        total(fact, "dias_atraso", where, takes),
        rows(fact, f"{where} AND dias_atraso IS NOT NULL", takes),
    )


def _mean_parts(fact: str, value: str, where: str = "true", takes=()) -> tuple[Atom, Atom]:
    return (
        hundredths_total(fact, value, where, takes),
        rows(fact, f"{where} AND {value} IS NOT NULL", takes),
    )


ATOMS: dict[str, Atom] = {
    # projects
    "projetos": rows(PROJECT),
    "projetos_ativos": rows(PROJECT, RUNNING, ["status"]),
    "projetos_execucao": rows(PROJECT, "status = 'Em execução'", ["status"]),
    "projetos_concluidos": rows(PROJECT, DONE, ["status"]),
    "projetos_atrasados": rows(PROJECT, "situacao_prazo = 'Atrasado'", ["situacao_prazo"]),
    "projetos_no_prazo":
        rows(PROJECT, "situacao_prazo = 'Concluído no prazo'", ["situacao_prazo"]),
    "projetos_vermelhos": rows(PROJECT, "farol = 'Vermelho'", ["farol"]),
    "projetos_ideias": rows(PROJECT, "origem = 'Ideia'", ["origem"]),
    "horas_orcadas": total(PROJECT, "horas_orcadas"),
    "orcamento": hundredths_total(PROJECT, "orcamento"),
    # tasks
    "tarefas": rows(TASK),
    "tarefas_abertas": rows(TASK, "aberta", ["aberta"]),
    "abertas_com_prazo":
        rows(TASK, "aberta AND data_limite IS NOT NULL", ["aberta", "data_limite"]),
    "tarefas_concluidas": rows(TASK, DONE, ["status"]),
    "tarefas_impedidas": rows(TASK, "status = 'Impedido'", ["status"]),
    "tarefas_vencidas": rows(TASK, "situacao_prazo = 'Vencida'", ["situacao_prazo"]),
    "entregues_no_prazo":
        rows(TASK, "situacao_prazo = 'Concluída no prazo'", ["situacao_prazo"]),
    "entregues_com_prazo":
        rows(TASK, "situacao_prazo IN ('Concluída no prazo', 'Concluída com atraso')",
             ["situacao_prazo"]),
    "concluidas_retrabalho":
        rows(TASK, f"{DONE} AND qtd_retrabalho > 0", ["status", "qtd_retrabalho"]),
    "horas_estimadas": hundredths_total(TASK, "estimativa_horas"),
    "horas_apontadas": hundredths_total(TASK, "horas_apontadas"),
    # a table filter narrows the context instead of taking the column over
    "estimadas_concluidas": hundredths_total(TASK, "estimativa_horas", DONE),
    "apontadas_concluidas": hundredths_total(TASK, "horas_apontadas", DONE),
    "dias_bloqueada": hundredths_total(TASK, "dias_bloqueada"),
    "tarefas_entregues": rows(TASK, DONE, ["status"], date="data_conclusao"),
    "ciclo_mediano": Atom(TASK, median_of="ciclo_dias"),
    # visits
    "tarefas_paradas": Atom(
        VISIT, f"max(CASE WHEN {STALLED} THEN 1 END)", per_task=True,
        overrides=frozenset({f"{VISIT}.etapa_atual", f"{VISIT}.etapa_final"})),
    "paradas_15_dias": Atom(
        VISIT, f"max(CASE WHEN {STALLED} AND dias_na_etapa > 15 THEN 1 END)", per_task=True,
        overrides=frozenset(
            {f"{VISIT}.etapa_atual", f"{VISIT}.etapa_final", f"{VISIT}.dias_na_etapa"})),
    "mudancas": rows(VISIT, date="data_entrada"),
    "bloqueios": rows(VISIT, "status = 'Impedido'", ["status"], date="data_entrada"),
    # parameters
    "referencia": Atom(PARAMETERS, "max(data_referencia)", "max"),
}
_PAIRS = {
    "atraso_projetos": _delay(PROJECT, LATE_PROJECT),
    "atraso_tarefas": _delay(TASK, LATE_TASK),
    "lead": _mean_parts(TASK, "lead_time_dias"),
    "ciclo": _mean_parts(TASK, "ciclo_dias"),
    "idade": _mean_parts(TASK, "idade_dias"),
    "etapa": _mean_parts(VISIT, "dias_na_etapa", "NOT etapa_atual", ["etapa_atual"]),
}
for _name, (_sum, _count) in _PAIRS.items():
    ATOMS[f"{_name}_soma"], ATOMS[f"{_name}_qtd"] = _sum, _count


def _only(atom: str):
    return lambda: F.col(atom)


def _hundredths(atom: str):
    """Hours and money are added as whole hundredths: the same whatever the row order."""
    return lambda: F.col(atom) / 100


def _used_budget() -> Column:
    return F.try_divide(F.col("horas_apontadas") / 100, F.col("horas_orcadas"))


def _ratio(part: str, whole: str):
    return lambda: F.try_divide(F.col(part), F.col(whole))


def _mean(pair: str, unit: int):
    return lambda: F.try_divide(F.col(f"{pair}_soma"), F.col(f"{pair}_qtd")) / unit


def _minus_one(part: str, whole: str) -> Column:
    """BLANK counts as zero in a subtraction, so an empty ratio gives -1."""
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)) - 1


def _effort() -> Column:
    return _minus_one("apontadas_concluidas", "estimadas_concluidas")


def _balance() -> Column:
    created, delivered = F.col("tarefas"), F.col("tarefas_entregues")
    value = F.coalesce(created, F.lit(0)) - F.coalesce(delivered, F.lit(0))
    return F.when(created.isNotNull() | delivered.isNotNull(), value)


def _sentence(*parts: str | Column):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _count(atom: str) -> Column:
    return whole_br(F.col(atom))


def _share(part: str, whole: str) -> Column:
    return percent_br(F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)))


def _m(name, atoms, value, text=False) -> Measure:
    dense = text or value is _effort
    return Measure(name, tuple(atoms.split()), value, text, dense)


# fixed values: names and sentences of the measures
CATALOG: list[Measure] = [
    _m("Projetos", "projetos", _only("projetos")),
    _m("Projetos Ativos", "projetos_ativos", _only("projetos_ativos")),
    _m("Projetos em Execução", "projetos_execucao", _only("projetos_execucao")),
    _m("Projetos Concluídos", "projetos_concluidos", _only("projetos_concluidos")),
    _m("Projetos Atrasados", "projetos_atrasados", _only("projetos_atrasados")),
    _m("% Projetos Atrasados", "projetos_atrasados projetos_ativos",
       _ratio("projetos_atrasados", "projetos_ativos")),
    _m("% Projetos Entregues no Prazo", "projetos_no_prazo projetos_concluidos",
       _ratio("projetos_no_prazo", "projetos_concluidos")),
    _m("Atraso Médio dos Projetos (dias)", "atraso_projetos_soma atraso_projetos_qtd",
       _mean("atraso_projetos", 1)),
    _m("Horas Orçadas", "horas_orcadas", _only("horas_orcadas")),
    _m("% Orçamento Consumido", "horas_apontadas horas_orcadas",
       lambda: _used_budget()),
    _m("Orçamento", "orcamento", _hundredths("orcamento")),
    _m("Projetos Farol Vermelho", "projetos_vermelhos", _only("projetos_vermelhos")),
    _m("Projetos de Ideias", "projetos_ideias", _only("projetos_ideias")),
    _m("Tarefas", "tarefas", _only("tarefas")),
    _m("Tarefas Abertas", "tarefas_abertas", _only("tarefas_abertas")),
    _m("Tarefas Concluídas", "tarefas_concluidas", _only("tarefas_concluidas")),
    _m("Tarefas Impedidas", "tarefas_impedidas", _only("tarefas_impedidas")),
    _m("Tarefas Vencidas", "tarefas_vencidas", _only("tarefas_vencidas")),
    _m("% Abertas Vencidas", "tarefas_vencidas abertas_com_prazo",
       _ratio("tarefas_vencidas", "abertas_com_prazo")),
    _m("% Entregues no Prazo", "entregues_no_prazo entregues_com_prazo",
       _ratio("entregues_no_prazo", "entregues_com_prazo")),
    _m("Atraso Médio das Tarefas (dias)", "atraso_tarefas_soma atraso_tarefas_qtd",
       _mean("atraso_tarefas", 1)),
    _m("Lead Time Médio (dias)", "lead_soma lead_qtd", _mean("lead", 100)),
    _m("Ciclo Médio (dias)", "ciclo_soma ciclo_qtd", _mean("ciclo", 100)),
    _m("Ciclo Mediano (dias)", "ciclo_mediano", _only("ciclo_mediano")),
    _m("Idade Média das Abertas (dias)", "idade_soma idade_qtd", _mean("idade", 100)),
    _m("Dias Bloqueada", "dias_bloqueada", _hundredths("dias_bloqueada")),
    _m("% Concluídas com Retrabalho", "concluidas_retrabalho tarefas_concluidas",
       _ratio("concluidas_retrabalho", "tarefas_concluidas")),
    _m("Horas Estimadas", "horas_estimadas", _hundredths("horas_estimadas")),
    _m("Horas Apontadas", "horas_apontadas", _hundredths("horas_apontadas")),
    _m("Desvio de Esforço %", "apontadas_concluidas estimadas_concluidas",
       _effort),
    _m("Tarefas Criadas", "tarefas", _only("tarefas")),
    _m("Tarefas Entregues", "tarefas_entregues", _only("tarefas_entregues")),
    _m("Saldo do Período", "tarefas tarefas_entregues", _balance),
    _m("% Tarefas Concluídas", "tarefas_concluidas tarefas",
       _ratio("tarefas_concluidas", "tarefas")),
    _m("Tempo Médio na Etapa (dias)", "etapa_soma etapa_qtd", _mean("etapa", 100)),
    _m("Tarefas Paradas na Etapa", "tarefas_paradas", _only("tarefas_paradas")),
    _m("Paradas há mais de 15 dias", "paradas_15_dias", _only("paradas_15_dias")),
    _m("Mudanças de Status", "mudancas", _only("mudancas")),
    _m("Bloqueios no Período", "bloqueios", _only("bloqueios")),
    _m("Data de Referência", "referencia",
       lambda: F.date_format("referencia", "dd/MM/yyyy"), True),
    _m("Texto Referência", "referencia",
       lambda: _sentence("Dados até ", F.date_format("referencia", "dd/MM/yyyy")), True),
    _m("Contexto Projetos Ativos", "projetos",
       lambda: _sentence("de ", _count("projetos"), " no portfólio"), True),
    _m("Contexto Projetos Atrasados", "projetos_atrasados projetos_ativos",
       lambda: _sentence(_share("projetos_atrasados", "projetos_ativos"), " dos ativos"), True),
    _m("Contexto Atrasados de Ativos", "projetos_atrasados projetos_ativos",
       lambda: _sentence(_count("projetos_atrasados"), " de ", _count("projetos_ativos"),
                         " ativos"), True),
    _m("Contexto Entregues no Prazo", "projetos_no_prazo projetos_concluidos",
       lambda: _sentence(_count("projetos_no_prazo"), " de ", _count("projetos_concluidos"),
                         " concluídos"), True),
    _m("Contexto Tarefas Abertas", "tarefas_impedidas",
       lambda: _sentence(_count("tarefas_impedidas"), " impedidas agora"), True),
    _m("Contexto Tarefas Vencidas", "tarefas_vencidas abertas_com_prazo",
       lambda: _sentence(_share("tarefas_vencidas", "abertas_com_prazo"), " das abertas"), True),
    _m("Contexto Tarefas Concluídas", "tarefas_concluidas tarefas",
       lambda: _sentence(_share("tarefas_concluidas", "tarefas"), " de todas as tarefas"), True),
    _m("Contexto Horas Apontadas", "horas_apontadas horas_estimadas",
       lambda: _sentence(signed_percent_br(_minus_one("horas_apontadas", "horas_estimadas")),
                         " vs. o estimado"), True),
    _m("Contexto Orçamento Consumido", "horas_apontadas horas_orcadas",
       lambda: _sentence(percent_br(F.coalesce(_used_budget(), F.lit(0.0))),
                         " das horas orçadas já usadas"), True),
    _m("Texto Orçamento", "orcamento",
       lambda: _sentence(
           "R$ ", F.coalesce(number_br(F.col("orcamento") / 100_000_000, 1), F.lit("")), " mi"),
       True),
    _m("Contexto Projetos de Ideias", "projetos_ideias",
       lambda: _sentence(_count("projetos_ideias"), " vieram de ideias"), True),
]
BY_NAME = {m.name: m for m in CATALOG}

# the schedule's colour and fill are evaluated per cell, in worklens.operators.spans
SCHEDULE = ["Cronograma Cor", "Cronograma"]
PERIOD = [
    "Tarefas Criadas", "Tarefas Entregues", "Saldo do Período", "Mudanças de Status",
    "Bloqueios no Período",
]


def measure(
    model: Model, names: Sequence[str], by: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None, portfolio: str | None = None,
) -> DataFrame:
    """Named measures by any model columns (``"dim_projeto.farol"``) under category filters.

    ``portfolio`` is the security filter of a role: no measure's own condition can lift it.
    """
    chosen = [BY_NAME[name] for name in names]
    return evaluate(model, chosen, ATOMS, Context(tuple(by), dict(filters or {}), portfolio))


def as_role(role: str) -> str:
    """The portfolio a role may see."""
    return ROLES[role]


def long_form(values: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per measure: ``medida, valor, texto``, after the columns ``keys`` of its row."""
    cells = [
        F.struct(
            F.lit(name).alias("medida"),
            (F.lit(None) if BY_NAME[name].is_text else F.col(f"`{name}`")).cast("double")
            .alias("valor"),
            (F.col(f"`{name}`") if BY_NAME[name].is_text else F.lit(None)).cast("string")
            .alias("texto"),
        )
        for name in names
    ]
    return values.select(*keys, F.explode(F.array(*cells)).alias("m")).select(*keys, "m.*")
