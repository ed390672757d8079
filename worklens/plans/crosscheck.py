"""A second definition of the measures, in SQL over the raw facts, to reconcile against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.plans.gold import Model
from worklens.plans.measures import long_form, measure

PROJECT_ROWS = """
WITH p AS (
  SELECT *, etapa <> 'Concluído' AND situacao = 'Ativo' AND etiquetas NOT LIKE '%Em espera%' AS vivo,
         coalesce(data_limite < (SELECT max(data_referencia) FROM {ref}), false) AS passou,
         coalesce(data_conclusao <= data_limite, false) AS cumpriu
  FROM {projects}
)"""
PROJECT_VALUES = """
       count(*) AS `Projetos`,
       nullif(count_if(vivo), 0) AS `Projetos Ativos`,
       nullif(count_if(vivo AND etapa <> 'Planejamento'), 0) AS `Projetos em Execução`,
       nullif(count_if(situacao = 'Concluído'), 0) AS `Projetos Concluídos`,
       nullif(count_if(vivo AND passou), 0) AS `Projetos Atrasados`,
       try_divide(nullif(count_if(vivo AND passou), 0), count_if(vivo)) AS `% Projetos Atrasados`,
       try_divide(nullif(count_if(situacao = 'Concluído' AND cumpriu), 0),
                  count_if(situacao = 'Concluído')) AS `% Projetos Entregues no Prazo`,
       try_divide(
         sum(dias_atraso) FILTER (WHERE vivo AND passou OR situacao = 'Concluído' AND NOT cumpriu),
         count(dias_atraso) FILTER (WHERE vivo AND passou OR situacao = 'Concluído' AND NOT cumpriu))
         AS `Atraso Médio dos Projetos (dias)`,
       sum(horas_orcadas) AS `Horas Orçadas`,
       sum(orcamento) AS `Orçamento`,
       nullif(count_if(farol = 'Vermelho'), 0) AS `Projetos Farol Vermelho`,
       nullif(count_if(origem_id LIKE 'IDE-%'), 0) AS `Projetos de Ideias`"""
PROJECTS = f"""{PROJECT_ROWS}
SELECT {PROJECT_VALUES},
       try_divide((SELECT sum(horas_apontadas) FROM {{tasks}}), sum(horas_orcadas))
         AS `% Orçamento Consumido`
FROM p
"""
TASK_ROWS = """
WITH t AS (
  SELECT *, concluida_em IS NOT NULL AS feita, concluida_em IS NULL AND status <> 'Arquivada' AS viva,
         (SELECT max(data_referencia) FROM {ref}) AS hoje
  FROM {tasks}
)"""
TASK_VALUES = """
       nullif(count(*), 0) AS `Tarefas`,
       nullif(count_if(viva), 0) AS `Tarefas Abertas`,
       nullif(count_if(feita), 0) AS `Tarefas Concluídas`,
       nullif(count_if(viva AND status = 'Impedido'), 0) AS `Tarefas Impedidas`,
       nullif(count_if(viva AND data_limite < hoje), 0) AS `Tarefas Vencidas`,
       try_divide(nullif(count_if(viva AND data_limite < hoje), 0),
                  count_if(viva AND data_limite IS NOT NULL)) AS `% Abertas Vencidas`,
       try_divide(nullif(count_if(feita AND data_conclusao <= data_limite), 0),
                  count_if(feita AND data_limite IS NOT NULL)) AS `% Entregues no Prazo`,
       try_divide(
         sum(datediff(coalesce(data_conclusao, hoje), data_limite)) FILTER (WHERE dias_atraso > 0),
         count_if(dias_atraso > 0)) AS `Atraso Médio das Tarefas (dias)`,
       avg(timestampdiff(SECOND, criada_em, concluida_em)) / 86400 AS `Lead Time Médio (dias)`,
       avg(timestampdiff(SECOND, criada_em, timestamp(date_add(hoje, 1))) - 1)
         FILTER (WHERE viva) / 86400 AS `Idade Média das Abertas (dias)`,
       sum(estimativa_horas) AS `Horas Estimadas`,
       sum(horas_apontadas) AS `Horas Apontadas`,
       coalesce(try_divide(sum(horas_apontadas) FILTER (WHERE feita),
                           sum(estimativa_horas) FILTER (WHERE feita)), 0) - 1 AS `Desvio de Esforço %`,
       try_divide(nullif(count_if(feita), 0), count(*)) AS `% Tarefas Concluídas`"""
TASKS = f"{TASK_ROWS}\nSELECT {TASK_VALUES}\nFROM t\n"
# the same for every role and the total in one pass; a role is the portfolio it may see
PROJECT_ROLES = f"""{PROJECT_ROWS}, gasto AS (
  SELECT projeto_id AS de, sum(horas_apontadas) AS horas FROM {{tasks}} GROUP BY projeto_id
)
SELECT portfolio AS papel, grouping(portfolio) = 1 AS geral, {PROJECT_VALUES},
       try_divide(sum(horas), sum(horas_orcadas)) AS `% Orçamento Consumido`
FROM p LEFT JOIN gasto ON projeto_id = de
GROUP BY GROUPING SETS ((), (portfolio))
"""
TASK_ROLES = f"""{TASK_ROWS}, onde AS (SELECT projeto_id AS de, portfolio FROM {{projects}})
SELECT portfolio AS papel, grouping(portfolio) = 1 AS geral, {TASK_VALUES}
FROM t LEFT JOIN onde ON projeto_id = de
GROUP BY GROUPING SETS ((), (portfolio))
"""
VISITS = """
WITH por_tarefa AS (
  SELECT tarefa_id,
         max(status) FILTER (WHERE saida_em IS NULL) AS onde,
         max(dias_na_etapa) FILTER (WHERE saida_em IS NULL) AS parada,
         sum(dias_na_etapa) FILTER (WHERE saida_em IS NOT NULL) AS dias,
         count(dias_na_etapa) FILTER (WHERE saida_em IS NOT NULL) AS vezes,
         sum(dias_na_etapa) FILTER (WHERE status = 'Impedido') AS bloqueada,
         bool_or(status_anterior = 'Em revisão' AND status = 'Fazendo') AS voltou
  FROM {visits} GROUP BY tarefa_id
)
SELECT try_divide(sum(dias), sum(vezes)) AS `Tempo Médio na Etapa (dias)`,
       count_if(onde NOT IN ('Concluído', 'Arquivada')) AS `Tarefas Paradas na Etapa`,
       count_if(parada > 15) AS `Paradas há mais de 15 dias`,
       sum(bloqueada) AS `Dias Bloqueada`,
       try_divide(count_if(onde = 'Concluído' AND voltou), count_if(onde = 'Concluído'))
         AS `% Concluídas com Retrabalho`,
       (SELECT try_divide(sum(ciclo_dias), count(ciclo_dias)) FROM {tasks}) AS `Ciclo Médio (dias)`,
       (SELECT percentile(ciclo_dias, 0.5) FROM {tasks}) AS `Ciclo Mediano (dias)`
FROM por_tarefa
"""


def _br(count: str) -> str:
    return f"translate(format_number({count}, 0), ',', '.')"


def _percent(ratio: str) -> str:
    return f"concat({_br(f'round(coalesce({ratio}, 0), 2) * 100')}, '%')"


PROJECT_TEXTS = f"""
WITH p AS (
  SELECT *, etapa <> 'Concluído' AND situacao = 'Ativo' AND etiquetas NOT LIKE '%Em espera%' AS vivo,
         coalesce(data_limite < (SELECT max(data_referencia) FROM {{ref}}), false) AS passou,
         coalesce(data_conclusao <= data_limite, false) AS cumpriu
  FROM {{projects}}
), n AS (
  SELECT count(*) AS todos, count_if(vivo) AS vivos, count_if(vivo AND passou) AS tarde,
         count_if(situacao = 'Concluído') AS feitos,
         count_if(situacao = 'Concluído' AND cumpriu) AS cumpridos,
         count_if(origem_id LIKE 'IDE-%') AS ideias, sum(orcamento) AS dinheiro,
         try_divide((SELECT sum(horas_apontadas) FROM {{tasks}}), sum(horas_orcadas)) AS gasto,
         (SELECT date_format(max(data_referencia), 'dd/MM/yyyy') FROM {{ref}}) AS hoje
  FROM p
)
SELECT hoje AS `Data de Referência`, concat('Dados até ', hoje) AS `Texto Referência`,
       concat('de ', {_br('todos')}, ' no portfólio') AS `Contexto Projetos Ativos`,
       concat({_percent('try_divide(tarde, vivos)')}, ' dos ativos')
         AS `Contexto Projetos Atrasados`,
       concat({_br('tarde')}, ' de ', {_br('vivos')}, ' ativos') AS `Contexto Atrasados de Ativos`,
       concat({_br('cumpridos')}, ' de ', {_br('feitos')}, ' concluídos')
         AS `Contexto Entregues no Prazo`,
       concat({_percent('gasto')}, ' das horas orçadas já usadas') AS `Contexto Orçamento Consumido`,
       concat('R$ ', coalesce(translate(format_number(round(dinheiro / 1000000, 1), 1), ',.', '.,'),
              ''), ' mi') AS `Texto Orçamento`,
       concat({_br('ideias')}, ' vieram de ideias') AS `Contexto Projetos de Ideias`
FROM n
"""
TASK_TEXTS = f"""
WITH t AS (
  SELECT *, concluida_em IS NOT NULL AS feita, concluida_em IS NULL AND status <> 'Arquivada' AS viva,
         (SELECT max(data_referencia) FROM {{ref}}) AS hoje
  FROM {{tasks}}
), n AS (
  SELECT count_if(viva AND status = 'Impedido') AS impedidas, count(*) AS todas,
         count_if(viva AND data_limite < hoje) AS vencidas, count_if(feita) AS feitas,
         count_if(viva AND data_limite IS NOT NULL) AS com_prazo,
         coalesce(try_divide(sum(horas_apontadas), sum(estimativa_horas)), 0) - 1 AS desvio
  FROM t
)
SELECT concat({_br('impedidas')}, ' impedidas agora') AS `Contexto Tarefas Abertas`,
       concat({_percent('try_divide(vencidas, com_prazo)')}, ' das abertas')
         AS `Contexto Tarefas Vencidas`,
       concat({_percent('try_divide(feitas, todas)')}, ' de todas as tarefas')
         AS `Contexto Tarefas Concluídas`,
       concat(CASE WHEN round(desvio, 2) > 0 THEN '+' ELSE '' END, {_percent('desvio')},
              ' vs. o estimado') AS `Contexto Horas Apontadas`
FROM n
"""
PERIOD = """
SELECT nullif(criadas, 0) AS `Tarefas Criadas`, nullif(entregues, 0) AS `Tarefas Entregues`,
       CASE WHEN criadas + entregues > 0 THEN criadas - entregues END AS `Saldo do Período`
FROM (SELECT count_if(date_format(data_criacao, 'yyyyMM') = '{month}') AS criadas,
             count_if(status = 'Concluído' AND date_format(data_conclusao, 'yyyyMM') = '{month}')
               AS entregues
      FROM {tasks})
"""
PERIOD_VISITS = """
SELECT nullif(count(*), 0) AS `Mudanças de Status`,
       nullif(count_if(status = 'Impedido'), 0) AS `Bloqueios no Período`
FROM {visits} WHERE date_format(data_entrada, 'yyyyMM') = '{month}'
"""
PROJECT_NAMES = [
    "Projetos", "Projetos Ativos", "Projetos em Execução", "Projetos Concluídos",
    "Projetos Atrasados", "% Projetos Atrasados", "% Projetos Entregues no Prazo",
    "Atraso Médio dos Projetos (dias)", "Horas Orçadas", "% Orçamento Consumido", "Orçamento",
    "Projetos Farol Vermelho", "Projetos de Ideias",
]
TASK_NAMES = [
    "Tarefas", "Tarefas Abertas", "Tarefas Concluídas", "Tarefas Impedidas", "Tarefas Vencidas",
    "% Abertas Vencidas", "% Entregues no Prazo", "Atraso Médio das Tarefas (dias)",
    "Lead Time Médio (dias)", "Idade Média das Abertas (dias)", "Horas Estimadas",
    "Horas Apontadas", "Desvio de Esforço %", "% Tarefas Concluídas",
]
PROJECT_TEXT_NAMES = [
    "Data de Referência", "Texto Referência", "Contexto Projetos Ativos",
    "Contexto Projetos Atrasados", "Contexto Atrasados de Ativos", "Contexto Entregues no Prazo",
    "Contexto Orçamento Consumido", "Texto Orçamento", "Contexto Projetos de Ideias",
]
TASK_TEXT_NAMES = [
    "Contexto Tarefas Abertas", "Contexto Tarefas Vencidas", "Contexto Tarefas Concluídas",
    "Contexto Horas Apontadas",
]
PERIOD_NAMES = ["Tarefas Criadas", "Tarefas Entregues", "Saldo do Período"]
PERIOD_VISIT_NAMES = ["Mudanças de Status", "Bloqueios no Período"]
ROLE_NAMES = PROJECT_NAMES + TASK_NAMES
NAMES = PROJECT_NAMES + TASK_NAMES + PROJECT_TEXT_NAMES + TASK_TEXT_NAMES
FLOW_NAMES = [
    "Tempo Médio na Etapa (dias)", "Tarefas Paradas na Etapa", "Paradas há mais de 15 dias",
    "Dias Bloqueada", "% Concluídas com Retrabalho", "Ciclo Médio (dias)", "Ciclo Mediano (dias)",
]


def _tables(model: Model) -> dict[str, DataFrame]:
    return {"projects": model["dim_projeto"], "tasks": model["fato_tarefa"],
            "ref": model["ref_parametros"].select("data_referencia")}


def independent(spark: SparkSession, model: Model) -> DataFrame:
    """Project and task measures and the texts made of them, without any filter."""
    tables = _tables(model)
    parts = [
        long_form(spark.sql(text, **tables), names) for text, names in (
            (PROJECTS, PROJECT_NAMES), (TASKS, TASK_NAMES), (PROJECT_TEXTS, PROJECT_TEXT_NAMES),
            (TASK_TEXTS, TASK_TEXT_NAMES))
    ]
    return reduce(DataFrame.unionByName, parts)


def independent_roles(spark: SparkSession, model: Model) -> DataFrame:
    """``papel, medida, valor, texto``: the numbers of projects and tasks as each role sees them, and
    as no role does (``papel`` NULL)."""
    tables = _tables(model)
    parts = [
        long_form(spark.sql(text, **tables).where("geral OR papel IS NOT NULL"), names, ["papel"])
        for text, names in ((PROJECT_ROLES, PROJECT_NAMES), (TASK_ROLES, TASK_NAMES))
    ]
    return reduce(DataFrame.unionByName, parts)


def role_values(model: Model) -> DataFrame:
    """The same by the measures themselves: a role's portfolio is one value of the portfolio axis."""
    by_role = measure(model, ROLE_NAMES, ["dim_projeto.portfolio"]).where("portfolio IS NOT NULL")
    total = measure(model, ROLE_NAMES).withColumn("papel", F.lit(None).cast("string"))
    rows = by_role.withColumnRenamed("portfolio", "papel").unionByName(total)
    return long_form(rows, ROLE_NAMES, ["papel"])


def independent_flow(spark: SparkSession, model: Model) -> DataFrame:
    """Measures of the visit history, without any filter."""
    tables = {**_tables(model), "visits": model["fato_passagem_status"]}
    return long_form(spark.sql(VISITS, **tables), FLOW_NAMES)


def independent_period(spark: SparkSession, model: Model, month: str) -> DataFrame:
    """Tasks created and delivered in a month (``yyyyMM``)."""
    tasks = model["fato_tarefa"]
    return long_form(spark.sql(PERIOD, tasks=tasks, month=_digits(month)), PERIOD_NAMES)


def independent_period_flow(spark: SparkSession, model: Model, month: str) -> DataFrame:
    """Moves and blocks of a month (``yyyyMM``)."""
    visits = model["fato_passagem_status"]
    return long_form(
        spark.sql(PERIOD_VISITS, visits=visits, month=_digits(month)), PERIOD_VISIT_NAMES)


def _digits(month: str) -> int:
    return int(month)
