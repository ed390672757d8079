"""Measures by axis, under slicers, overrides and roles, and against independent definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.operators.compare import reconcile
from worklens.plans import crosscheck
from worklens.plans.measures import long_form, measure
from worklens.queries.registry import query
from worklens.queries.sql import hundredths
from worklens.sources import warehouse as W

MONTH = """list_extract(['jan', 'fev', 'mar', 'abr', 'mai', 'jun', 'jul', 'ago', 'set', 'out',
                         'nov', 'dez'], CAST(month({0}) AS INTEGER)) || '/' || strftime({0}, '%y')"""
BLANK = "nullif(count(*) FILTER (WHERE {0}), 0)"
RUNNING = "status IN ('Em execução', 'Planejamento')"


def blank(condition: str) -> str:
    return BLANK.format(condition)


@query("measures_projects", f"""
SELECT portfolio, count(*) AS "Projetos", {blank(RUNNING)} AS "Projetos Ativos",
       {blank("status = 'Em execução'")} AS "Projetos em Execução",
       {blank("status = 'Concluído'")} AS "Projetos Concluídos",
       {blank("situacao_prazo = 'Atrasado'")} AS "Projetos Atrasados",
       "Projetos Atrasados" / nullif("Projetos Ativos", 0) AS "% Projetos Atrasados",
       {blank("situacao_prazo = 'Concluído no prazo'")} / nullif("Projetos Concluídos", 0)
         AS "% Projetos Entregues no Prazo",
       avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Atrasado', 'Concluído com atraso'))
         AS "Atraso Médio dos Projetos (dias)",
       CAST(sum(horas_orcadas) AS BIGINT) AS "Horas Orçadas",
       {blank("farol = 'Vermelho'")} AS "Projetos Farol Vermelho",
       {blank("origem = 'Ideia'")} AS "Projetos de Ideias"
FROM dim GROUP BY portfolio
""")
def measures_projects(spark, sf_dir):
    names = [
        "Projetos", "Projetos Ativos", "Projetos em Execução", "Projetos Concluídos",
        "Projetos Atrasados", "% Projetos Atrasados", "% Projetos Entregues no Prazo",
        "Atraso Médio dos Projetos (dias)", "Horas Orçadas", "Projetos Farol Vermelho",
        "Projetos de Ideias",
    ]
    return measure(W.delivery_model(spark, sf_dir), names, ["dim_projeto.portfolio"])


@query("measures_budget", """
SELECT farol, CAST(sum(CAST(round(orcamento * 100) AS BIGINT)) AS BIGINT) / 100 AS orcamento,
       'R$ ' || replace(replace(replace(format('{:,.1f}', round(sum(orcamento) / 1000000, 1)),
         ',', '#'), '.', ','), '#', '.') || ' mi' AS texto
FROM dim GROUP BY farol
""")
def measures_budget(spark, sf_dir):
    values = measure(
        W.delivery_model(spark, sf_dir), ["Orçamento", "Texto Orçamento"], ["dim_projeto.farol"])
    return values.select(
        "farol", F.col("Orçamento").alias("orcamento"),
        F.col("Texto Orçamento").alias("texto"))


@query("measures_tasks", f"""
SELECT tipo, count(*) AS "Tarefas", {blank("aberta")} AS "Tarefas Abertas",
       {blank("status = 'Concluído'")} AS "Tarefas Concluídas",
       {blank("status = 'Impedido'")} AS "Tarefas Impedidas",
       {blank("situacao_prazo = 'Vencida'")} AS "Tarefas Vencidas",
       "Tarefas Vencidas" / {blank("aberta AND data_limite IS NOT NULL")} AS "% Abertas Vencidas",
       {blank("situacao_prazo = 'Concluída no prazo'")}
         / {blank("situacao_prazo IN ('Concluída no prazo', 'Concluída com atraso')")}
         AS "% Entregues no Prazo",
       avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Vencida', 'Concluída com atraso'))
         AS "Atraso Médio das Tarefas (dias)",
       "Tarefas Concluídas" / "Tarefas" AS "% Tarefas Concluídas",
       CAST(sum(date_diff('day', data_criacao, data_conclusao)) * 100 AS BIGINT)
         / count(data_conclusao) / 100 AS "Lead Time Médio (dias)"
FROM tasks GROUP BY tipo
""")
def measures_tasks(spark, sf_dir):
    names = [
        "Tarefas", "Tarefas Abertas", "Tarefas Concluídas", "Tarefas Impedidas",
        "Tarefas Vencidas", "% Abertas Vencidas", "% Entregues no Prazo",
        "Atraso Médio das Tarefas (dias)", "% Tarefas Concluídas", "Lead Time Médio (dias)",
    ]
    return measure(W.delivery_model(spark, sf_dir), names, ["fato_tarefa.tipo"])


@query("measures_flow", f"""
SELECT p.portfolio, s."Tempo Médio na Etapa (dias)", s."Tarefas Paradas na Etapa",
       s."Paradas há mais de 15 dias", s."Mudanças de Status", s."Bloqueios no Período",
       t."Ciclo Médio (dias)", t."Idade Média das Abertas (dias)", t."Dias Bloqueada",
       t."% Concluídas com Retrabalho"
FROM (SELECT DISTINCT portfolio FROM flow_dim) p JOIN (
  SELECT d.portfolio,
         CAST(sum({hundredths('segundos')}) FILTER (WHERE NOT atual) AS BIGINT)
           / count(segundos) FILTER (WHERE NOT atual) / 100 AS "Tempo Médio na Etapa (dias)",
         nullif(count(DISTINCT v.tarefa_id) FILTER (WHERE atual AND NOT final), 0)
           AS "Tarefas Paradas na Etapa",
         nullif(count(DISTINCT v.tarefa_id) FILTER (WHERE atual AND NOT final
           AND {hundredths('segundos')} > 1500), 0) AS "Paradas há mais de 15 dias",
         count(*) AS "Mudanças de Status", {blank("v.etapa = 'Impedido'")} AS "Bloqueios no Período"
  FROM visits v JOIN tickets k ON k.tarefa_id = v.tarefa_id
  JOIN flow_dim d ON d.projeto_id = k.projeto_id GROUP BY d.portfolio) s USING (portfolio)
JOIN (
  SELECT d.portfolio,
         CAST(sum(ciclo_c) AS BIGINT) / count(ciclo_c) / 100 AS "Ciclo Médio (dias)",
         CAST(sum(idade_c) AS BIGINT) / count(idade_c) / 100 AS "Idade Média das Abertas (dias)",
         CAST(sum(bloqueada) AS BIGINT) / 100 AS "Dias Bloqueada",
         {blank("k.status = 'Concluído' AND retrabalho > 0")}
           / {blank("k.status = 'Concluído'")} AS "% Concluídas com Retrabalho"
  FROM flow_tasks k JOIN flow_dim d ON d.projeto_id = k.projeto_id
  GROUP BY d.portfolio) t USING (portfolio)
""")
def measures_flow(spark, sf_dir):
    """Visit and task measures by portfolio: visits fold to tasks, tasks to projects."""
    names = [
        "Tempo Médio na Etapa (dias)", "Tarefas Paradas na Etapa", "Paradas há mais de 15 dias",
        "Mudanças de Status", "Bloqueios no Período", "Ciclo Médio (dias)",
        "Idade Média das Abertas (dias)", "Dias Bloqueada", "% Concluídas com Retrabalho",
    ]
    model = W.flow_model(spark, sf_dir, kept=("passagens", "fato_tarefa", "dim_projeto"))
    return measure(model, names, ["dim_projeto.portfolio"])


@query("measure_basic", """
SELECT prioridade, count(*) AS linhas, CAST(sum(centesimos) AS BIGINT) AS centesimos,
       avg(dias_atraso) AS atraso_medio, min(data_criacao) AS primeira, max(data_limite) AS ultima
FROM tasks GROUP BY prioridade
""")
def measure_basic(spark, sf_dir):
    facts = W.delivery_model(spark, sf_dir)["fato_tarefa"]
    return facts.groupBy("prioridade").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(F.round(F.col("horas_apontadas") * 100).cast("bigint")).alias("centesimos"),
        F.avg("dias_atraso").alias("atraso_medio"),
        F.min("data_criacao").alias("primeira"),
        F.max("data_limite").alias("ultima"),
    )


@query("measure_median", """
SELECT portfolio, median(ciclo_c) / 100 AS "Ciclo Mediano (dias)"
FROM flow_tasks k JOIN flow_dim d ON d.projeto_id = k.projeto_id
GROUP BY portfolio HAVING count(ciclo_c) > 0
""")
def measure_median(spark, sf_dir):
    """Exact median: values are counted first, so a hot group costs its distinct values only."""
    return measure(
        W.flow_model(spark, sf_dir), ["Ciclo Mediano (dias)"], ["dim_projeto.portfolio"])


@query("measure_distinct", """
SELECT etapa AS status, count(DISTINCT tarefa_id) AS "Tarefas Paradas na Etapa"
FROM visits WHERE atual AND NOT final GROUP BY etapa
""")
def measure_distinct(spark, sf_dir):
    return measure(
        W.flow_model(spark, sf_dir), ["Tarefas Paradas na Etapa"], ["fato_passagem_status.status"])


@query("measure_ratio", f"""
SELECT prioridade, {blank("situacao_prazo = 'Concluída no prazo'")}
         / {blank("situacao_prazo IN ('Concluída no prazo', 'Concluída com atraso')")}
         AS "% Entregues no Prazo",
       {blank("status = 'Concluído'")} / count(*) AS "% Tarefas Concluídas"
FROM tasks GROUP BY prioridade
""")
def measure_ratio(spark, sf_dir):
    return measure(
        W.delivery_model(spark, sf_dir), ["% Entregues no Prazo", "% Tarefas Concluídas"],
        ["fato_tarefa.prioridade"])


@query("measure_cross_fact", """
SELECT d.portfolio, d.orcadas, t.apontadas, t.apontadas / d.orcadas AS consumido
FROM (SELECT portfolio, CAST(sum(horas_orcadas) AS BIGINT) AS orcadas FROM dim GROUP BY portfolio) d
JOIN (SELECT portfolio, CAST(sum(centesimos) AS BIGINT) / 100 AS apontadas
      FROM tasks JOIN dim USING (projeto_id) GROUP BY portfolio) t USING (portfolio)
""")
def measure_cross_fact(spark, sf_dir):
    """Hours logged over hours budgeted: each fact is aggregated before they meet."""
    values = measure(
        W.delivery_model(spark, sf_dir),
        ["Horas Orçadas", "Horas Apontadas", "% Orçamento Consumido"], ["dim_projeto.portfolio"])
    return values.select(
        "portfolio", F.col("Horas Orçadas").alias("orcadas"),
        F.col("Horas Apontadas").alias("apontadas"),
        F.col("% Orçamento Consumido").alias("consumido"))


@query("effort_deviation", """
SELECT tipo, CAST(sum(centesimos) FILTER (WHERE status = 'Concluído') AS BIGINT)
         / CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) FILTER (WHERE status = 'Concluído')
                AS BIGINT) - 1 AS desvio,
       CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) AS BIGINT) / 100 AS estimadas
FROM tasks GROUP BY tipo
""")
def effort_deviation(spark, sf_dir):
    """A table filter narrows the context; the hours of all tasks stay beside it."""
    values = measure(
        W.delivery_model(spark, sf_dir), ["Desvio de Esforço %", "Horas Estimadas"],
        ["fato_tarefa.tipo"])
    return values.select(
        "tipo", F.col("Desvio de Esforço %").alias("desvio"),
        F.col("Horas Estimadas").alias("estimadas"))


@query("created_vs_delivered", f"""
SELECT mes_ano, criadas AS "Tarefas Criadas", entregues AS "Tarefas Entregues",
       coalesce(criadas, 0) - coalesce(entregues, 0) AS "Saldo do Período"
FROM (SELECT {MONTH.format('data_criacao')} AS mes_ano, count(*) AS criadas
      FROM tasks GROUP BY 1)
FULL JOIN (SELECT {MONTH.format('data_conclusao')} AS mes_ano, count(*) AS entregues
           FROM tasks WHERE status = 'Concluído' GROUP BY 1) USING (mes_ano)
""")
def created_vs_delivered(spark, sf_dir):
    """Two date roles of one fact on one calendar axis."""
    return measure(
        W.delivery_model(spark, sf_dir),
        ["Tarefas Criadas", "Tarefas Entregues", "Saldo do Período"], ["dim_data.mes_ano"])


@query("monthly_counts", """
SELECT CAST(date_trunc('month', data_criacao) AS DATE) AS mes, count(*) AS criadas,
       count(*) FILTER (WHERE status = 'Concluído') AS concluidas
FROM tasks GROUP BY 1
""")
def monthly_counts(spark, sf_dir):
    facts = W.delivery_model(spark, sf_dir)["fato_tarefa"]
    return facts.groupBy(F.trunc("data_criacao", "month").alias("mes")).agg(
        F.count(F.lit(1)).alias("criadas"),
        F.count_if(F.col("status") == "Concluído").alias("concluidas"),
    )


@query("moves_by_month", f"""
SELECT {MONTH.format('dia')} AS mes_ano, count(*) AS "Mudanças de Status",
       {blank("etapa = 'Impedido'")} AS "Bloqueios no Período"
FROM (SELECT *, CAST(ts - INTERVAL 3 HOUR AS DATE) AS dia FROM visits) GROUP BY 1
""")
def moves_by_month(spark, sf_dir):
    """Moves by entry date, whatever month their task was created in."""
    return measure(
        W.flow_model(spark, sf_dir), ["Mudanças de Status", "Bloqueios no Período"],
        ["dim_data.mes_ano"])


@query("measures_by_axis", f"""
SELECT portfolio, count(DISTINCT d.projeto_id) AS "Projetos",
       nullif(count(t.tarefa_id), 0) AS "Tarefas",
       {blank("t.status = 'Concluído'")} AS "Tarefas Concluídas",
       CAST(sum(v.n) AS BIGINT) AS "Mudanças de Status"
FROM flow_dim d LEFT JOIN tickets t ON t.projeto_id = d.projeto_id
LEFT JOIN (SELECT tarefa_id, count(*) AS n FROM visits GROUP BY 1) v ON v.tarefa_id = t.tarefa_id
GROUP BY portfolio
""")
def measures_by_axis(spark, sf_dir):
    """Three grains on one axis, lined up without fan-out."""
    return measure(
        W.flow_model(spark, sf_dir),
        ["Projetos", "Tarefas", "Tarefas Concluídas", "Mudanças de Status"],
        ["dim_projeto.portfolio"])


@query("measures_sliced", f"""
SELECT t.tipo, count(*) AS "Tarefas", {blank("t.aberta")} AS "Tarefas Abertas",
       {blank("t.situacao_prazo = 'Vencida'")} AS "Tarefas Vencidas"
FROM tasks t JOIN dim d USING (projeto_id)
WHERE d.portfolio IN ('BUILDING', 'MACHINERY') AND d.status = 'Em execução'
GROUP BY t.tipo
""")
def measures_sliced(spark, sf_dir):
    """Slicers on portfolio and project status reach tasks through the project key."""
    return measure(
        W.delivery_model(spark, sf_dir), ["Tarefas", "Tarefas Abertas", "Tarefas Vencidas"],
        ["fato_tarefa.tipo"],
        {"dim_projeto.portfolio": ["BUILDING", "MACHINERY"],
         "dim_projeto.status": ["Em execução"]})


@query("filter_override", f"""
SELECT status, count(*) AS "Projetos", (SELECT count(*) FROM dim WHERE {RUNNING})
         AS "Projetos Ativos",
       (SELECT count(*) FROM dim WHERE status = 'Concluído') AS "Projetos Concluídos",
       {blank("situacao_prazo = 'Atrasado'")} AS "Projetos Atrasados"
FROM dim WHERE status IN ('Em execução', 'Em espera') GROUP BY status
""")
def filter_override(spark, sf_dir):
    """A measure's condition on a column replaces the slicer and the axis on that column."""
    return measure(
        W.delivery_model(spark, sf_dir),
        ["Projetos", "Projetos Ativos", "Projetos Concluídos", "Projetos Atrasados"],
        ["dim_projeto.status"], {"dim_projeto.status": ["Em execução", "Em espera"]})


@query("blank_semantics", f"""
SELECT etapa, {blank("situacao_prazo = 'Atrasado'")} AS "Projetos Atrasados",
       {blank("situacao_prazo = 'Atrasado'")} / {blank(RUNNING)} AS "% Projetos Atrasados",
       CAST(coalesce((200 * {blank("situacao_prazo = 'Atrasado'")} + {blank(RUNNING)})
                       // (2 * {blank(RUNNING)}), 0) AS VARCHAR) || '% dos ativos'
         AS "Contexto Projetos Atrasados"
FROM dim GROUP BY etapa
""")
def blank_semantics(spark, sf_dir):
    """No rows is BLANK, a division by BLANK is BLANK, and a text shows zero."""
    return measure(
        W.delivery_model(spark, sf_dir),
        ["Projetos Atrasados", "% Projetos Atrasados", "Contexto Projetos Atrasados"],
        ["dim_projeto.etapa"])


@query("rls_by_role", """
SELECT d.portfolio AS papel, count(DISTINCT d.projeto_id) AS "Projetos",
       nullif(count(t.tarefa_id), 0) AS "Tarefas",
       nullif(count(*) FILTER (WHERE t.aberta), 0) AS "Tarefas Abertas",
       CAST(sum(v.n) AS BIGINT) AS "Mudanças de Status"
FROM flow_dim d LEFT JOIN tickets t ON t.projeto_id = d.projeto_id
LEFT JOIN (SELECT tarefa_id, count(*) AS n FROM visits GROUP BY 1) v ON v.tarefa_id = t.tarefa_id
GROUP BY d.portfolio
""")
def rls_by_role(spark, sf_dir):
    """What every role sees of projects, tasks and visits, in one evaluation.

    A role sees one portfolio, so the portfolio axis gives all roles; for measures that no condition
    lifts off the portfolio each row equals the evaluation under that role's filter.
    """
    names = ["Projetos", "Tarefas", "Tarefas Abertas", "Mudanças de Status"]
    rows = measure(W.flow_model(spark, sf_dir), names, ["dim_projeto.portfolio"])
    return rows.where("portfolio IS NOT NULL").withColumnRenamed("portfolio", "papel")


@query("context_texts", """
SELECT 'de ' || replace(format('{:,}', (SELECT count(*) FROM dim)), ',', '.')
         || ' no portfólio' AS "Contexto Projetos Ativos",
       (SELECT replace(format('{:,}', count(*) FILTER (WHERE situacao_prazo = 'Atrasado')), ',',
          '.') || ' de ' || replace(format('{:,}', count(*) FILTER (
          WHERE status IN ('Em execução', 'Planejamento'))), ',', '.') || ' ativos' FROM dim)
         AS "Contexto Atrasados de Ativos",
       (SELECT replace(format('{:,}', count(*) FILTER (WHERE situacao_prazo = 'Concluído no prazo')),
          ',', '.') || ' de ' || replace(format('{:,}', count(*) FILTER (
          WHERE status = 'Concluído')), ',', '.') || ' concluídos' FROM dim)
         AS "Contexto Entregues no Prazo",
       (SELECT replace(format('{:,}', count(*)), ',', '.') || ' impedidas agora' FROM tasks
        WHERE status = 'Impedido') AS "Contexto Tarefas Abertas",
       (SELECT CAST((200 * count(*) FILTER (WHERE status = 'Concluído') + count(*))
                      // (2 * count(*)) AS VARCHAR) || '% de todas as tarefas' FROM tasks)
         AS "Contexto Tarefas Concluídas",
       (SELECT CAST((200 * count(*) FILTER (WHERE data_limite < DATE '2001-08-31') + count(*))
                      // (2 * count(*)) AS VARCHAR) || '% das abertas' FROM tasks
        WHERE aberta AND data_limite IS NOT NULL) AS "Contexto Tarefas Vencidas",
       (SELECT '+' || CAST(CAST(round(sum(centesimos) / sum(estimativa) - 100) AS INTEGER)
          AS VARCHAR) || '% vs. o estimado' FROM tasks)
         AS "Contexto Horas Apontadas",
       (SELECT replace(format('{:,}', count(*)), ',', '.') || ' vieram de ideias' FROM dim
        WHERE origem = 'Ideia') AS "Contexto Projetos de Ideias",
       'Dados até 31/08/2001' AS "Texto Referência", '31/08/2001' AS "Data de Referência"
""")
def context_texts(spark, sf_dir):
    names = [
        "Contexto Projetos Ativos", "Contexto Atrasados de Ativos", "Contexto Entregues no Prazo",
        "Contexto Tarefas Abertas", "Contexto Tarefas Concluídas", "Contexto Tarefas Vencidas",
        "Contexto Horas Apontadas", "Contexto Projetos de Ideias", "Texto Referência",
        "Data de Referência",
    ]
    return measure(W.delivery_model(spark, sf_dir), names)


def _row(name: str, value: str) -> str:
    return f"{{'medida': '{name}', 'valor': CAST({value} AS DOUBLE), 'texto': CAST(NULL AS VARCHAR)}}"


def _text(name: str, text: str) -> str:
    return f"{{'medida': '{name}', 'valor': CAST(NULL AS DOUBLE), 'texto': {text}}}"


def _whole(count: str) -> str:
    return f"replace(format('{{:,}}', {count}), ',', '.')"


def _rounded(part: str, whole: str) -> str:
    """Whole per cent, half upwards, exactly."""
    return f"CAST((200 * {part} + {whole}) // (2 * {whole}) AS VARCHAR) || '%'"


NUMBER_ROWS = [
    _row("Projetos", "todos"), _row("Projetos Ativos", "nullif(ativos, 0)"),
    _row("Projetos em Execução", "nullif(andando, 0)"), _row("Projetos Concluídos", "nullif(feitos, 0)"),
    _row("Projetos Atrasados", "nullif(tarde, 0)"), _row("% Projetos Atrasados", "tarde / ativos"),
    _row("% Projetos Entregues no Prazo", "cumpridos / feitos"),
    _row("Atraso Médio dos Projetos (dias)", "atraso"), _row("Horas Orçadas", "orcadas"),
    _row("% Orçamento Consumido", "centesimos / 100 / orcadas"), _row("Orçamento", "dinheiro / 100"),
    _row("Projetos Farol Vermelho", "nullif(vermelhos, 0)"),
    _row("Projetos de Ideias", "nullif(ideias, 0)"), _row("Tarefas", "n"),
    _row("Tarefas Abertas", "abertas"), _row("Tarefas Concluídas", "feitas"),
    _row("Tarefas Impedidas", "impedidas"), _row("Tarefas Vencidas", "vencidas"),
    _row("% Abertas Vencidas", "vencidas / com_prazo"),
    _row("% Entregues no Prazo", "pontuais / entregues_com_prazo"),
    _row("Atraso Médio das Tarefas (dias)", "atraso_t"), _row("Lead Time Médio (dias)", "lead"),
    _row("Idade Média das Abertas (dias)", "idade"), _row("Horas Estimadas", "estimados / 100"),
    _row("Horas Apontadas", "centesimos / 100"),
    _row("Desvio de Esforço %", "gastos_feitas / estimados_feitas - 1"),
    _row("% Tarefas Concluídas", "feitas / n"),
]
PROJECT_ROWS = ", ".join([
    *NUMBER_ROWS, _row("Tarefas Criadas", "criadas"),
    _row("Tarefas Entregues", "entregues"), _row("Saldo do Período", "criadas - entregues"),
    _text("Data de Referência", "'31/08/2001'"), _text("Texto Referência", "'Dados até 31/08/2001'"),
    _text("Contexto Projetos Ativos", f"'de ' || {_whole('todos')} || ' no portfólio'"),
    _text("Contexto Projetos Atrasados", f"{_rounded('tarde', 'ativos')} || ' dos ativos'"),
    _text("Contexto Atrasados de Ativos",
          f"{_whole('tarde')} || ' de ' || {_whole('ativos')} || ' ativos'"),
    _text("Contexto Entregues no Prazo",
          f"{_whole('cumpridos')} || ' de ' || {_whole('feitos')} || ' concluídos'"),
    _text("Contexto Orçamento Consumido",
          "replace(format('{:,}', CAST(round(centesimos / orcadas) AS BIGINT)), ',', '.')"
          " || '% das horas orçadas já usadas'"),
    _text("Texto Orçamento", "'R$ ' || replace(replace(replace(format('{:,.1f}', round(dinheiro"
          " / 100000000, 1)), ',', '#'), '.', ','), '#', '.') || ' mi'"),
    _text("Contexto Projetos de Ideias", f"{_whole('ideias')} || ' vieram de ideias'"),
    _text("Contexto Tarefas Abertas", f"{_whole('impedidas')} || ' impedidas agora'"),
    _text("Contexto Tarefas Vencidas", f"{_rounded('vencidas', 'com_prazo')} || ' das abertas'"),
    _text("Contexto Tarefas Concluídas", f"{_rounded('feitas', 'n')} || ' de todas as tarefas'"),
    _text("Contexto Horas Apontadas", "'+' || CAST(CAST(round(100 * centesimos / estimados - 100)"
          " AS INTEGER) AS VARCHAR) || '% vs. o estimado'"),
])


@query("reconcile_measures", f"""
, numeros AS (
  SELECT * FROM (
    SELECT count(*) AS todos, count(*) FILTER (WHERE {RUNNING}) AS ativos,
           count(*) FILTER (WHERE status = 'Em execução') AS andando,
           count(*) FILTER (WHERE status = 'Concluído') AS feitos,
           count(*) FILTER (WHERE situacao_prazo = 'Atrasado') AS tarde,
           count(*) FILTER (WHERE situacao_prazo = 'Concluído no prazo') AS cumpridos,
           avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Atrasado', 'Concluído com atraso'))
             AS atraso,
           CAST(sum(horas_orcadas) AS BIGINT) AS orcadas,
           CAST(sum(CAST(round(orcamento * 100) AS BIGINT)) AS BIGINT) AS dinheiro,
           count(*) FILTER (WHERE farol = 'Vermelho') AS vermelhos,
           count(*) FILTER (WHERE origem = 'Ideia') AS ideias
    FROM dim), (
    SELECT count(*) AS n, count(*) FILTER (WHERE aberta) AS abertas,
           count(*) FILTER (WHERE status = 'Concluído') AS feitas,
           count(*) FILTER (WHERE status = 'Impedido') AS impedidas,
           count(*) FILTER (WHERE situacao_prazo = 'Vencida') AS vencidas,
           count(*) FILTER (WHERE aberta AND data_limite IS NOT NULL) AS com_prazo,
           count(*) FILTER (WHERE situacao_prazo = 'Concluída no prazo') AS pontuais,
           count(*) FILTER (WHERE situacao_prazo IN ('Concluída no prazo', 'Concluída com atraso'))
             AS entregues_com_prazo,
           avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Vencida', 'Concluída com atraso'))
             AS atraso_t,
           avg(date_diff('day', data_criacao, data_conclusao)) AS lead,
           CAST(sum((date_diff('day', data_criacao, DATE '2001-09-01') * 8640000 - 100 + 43200)
                    // 86400) FILTER (WHERE aberta) AS BIGINT)
             / count(*) FILTER (WHERE aberta) / 100 AS idade,
           CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) AS BIGINT) AS estimados,
           CAST(sum(centesimos) AS BIGINT) AS centesimos,
           CAST(sum(centesimos) FILTER (WHERE status = 'Concluído') AS BIGINT) AS gastos_feitas,
           CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) FILTER (WHERE status = 'Concluído')
                AS BIGINT) AS estimados_feitas,
           count(*) FILTER (WHERE strftime(data_criacao, '%Y%m') = '200106') AS criadas,
           count(*) FILTER (WHERE status = 'Concluído'
                            AND strftime(data_conclusao, '%Y%m') = '200106') AS entregues
    FROM tasks)
), linhas_r AS (SELECT unnest([{PROJECT_ROWS}], recursive := true) FROM numeros)
SELECT medida, round(valor, 6) AS valor, texto, TRUE AS confere FROM linhas_r
""")
def reconcile_measures(spark, sf_dir):
    """Measures against a second definition in SQL, those of a period in one month."""
    model = W.delivery_model(spark, sf_dir)
    names, period = crosscheck.NAMES, crosscheck.PERIOD_NAMES
    ours = long_form(measure(model, names), names).unionByName(long_form(
        measure(model, period, filters={"dim_data.mes_ano": ["jun/01"]}), period))
    theirs = crosscheck.independent(spark, model).unionByName(
        crosscheck.independent_period(spark, model, "200106"))
    return _reconciled(ours, theirs)


def _reconciled(ours, theirs):
    return reconcile(ours, theirs).select(
        "medida", F.round("valor_a", 6).alias("valor"), F.col("texto_a").alias("texto"), "confere")


ROLE_ROWS = ", ".join(NUMBER_ROWS)


@query("reconcile_roles", f"""
, de_projetos AS (
    SELECT count(*) AS todos, count(*) FILTER (WHERE {RUNNING}) AS ativos,
           count(*) FILTER (WHERE status = 'Em execução') AS andando,
           count(*) FILTER (WHERE status = 'Concluído') AS feitos,
           count(*) FILTER (WHERE situacao_prazo = 'Atrasado') AS tarde,
           count(*) FILTER (WHERE situacao_prazo = 'Concluído no prazo') AS cumpridos,
           avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Atrasado', 'Concluído com atraso'))
             AS atraso,
           CAST(sum(horas_orcadas) AS BIGINT) AS orcadas,
           CAST(sum(CAST(round(orcamento * 100) AS BIGINT)) AS BIGINT) AS dinheiro,
           count(*) FILTER (WHERE farol = 'Vermelho') AS vermelhos,
           count(*) FILTER (WHERE origem = 'Ideia') AS ideias,
           portfolio AS papel, grouping(portfolio) AS geral
    FROM dim GROUP BY GROUPING SETS ((), (portfolio))
), de_tarefas AS (
    SELECT count(*) AS n, count(*) FILTER (WHERE aberta) AS abertas,
           count(*) FILTER (WHERE status = 'Concluído') AS feitas,
           count(*) FILTER (WHERE status = 'Impedido') AS impedidas,
           count(*) FILTER (WHERE situacao_prazo = 'Vencida') AS vencidas,
           count(*) FILTER (WHERE aberta AND data_limite IS NOT NULL) AS com_prazo,
           count(*) FILTER (WHERE situacao_prazo = 'Concluída no prazo') AS pontuais,
           count(*) FILTER (WHERE situacao_prazo IN ('Concluída no prazo', 'Concluída com atraso'))
             AS entregues_com_prazo,
           avg(dias_atraso) FILTER (WHERE situacao_prazo IN ('Vencida', 'Concluída com atraso'))
             AS atraso_t,
           avg(date_diff('day', data_criacao, data_conclusao)) AS lead,
           CAST(sum((date_diff('day', data_criacao, DATE '2001-09-01') * 8640000 - 100 + 43200)
                    // 86400) FILTER (WHERE aberta) AS BIGINT)
             / count(*) FILTER (WHERE aberta) / 100 AS idade,
           CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) AS BIGINT) AS estimados,
           CAST(sum(centesimos) AS BIGINT) AS centesimos,
           CAST(sum(centesimos) FILTER (WHERE status = 'Concluído') AS BIGINT) AS gastos_feitas,
           CAST(sum(CAST(round(estimativa * 100) AS BIGINT)) FILTER (WHERE status = 'Concluído')
                AS BIGINT) AS estimados_feitas,
           avg(date_diff('day', data_criacao, DATE '2001-09-01') * 86400 - 1)
             FILTER (WHERE aberta) / 86400 AS idade_exata,
           portfolio AS papel, grouping(portfolio) AS geral
    FROM (SELECT t.*, d.portfolio FROM tasks t LEFT JOIN dim d USING (projeto_id))
    GROUP BY GROUPING SETS ((), (portfolio))
), numeros AS (
  SELECT p.*, t.* EXCLUDE (papel, geral)
  FROM de_projetos p LEFT JOIN de_tarefas t
    ON t.geral = p.geral AND t.papel IS NOT DISTINCT FROM p.papel
), linhas_r AS (
  SELECT papel, idade_exata, unnest([{ROLE_ROWS}], recursive := true) FROM numeros
)
SELECT papel, medida, round(valor, 6) AS valor, round(
         CASE medida WHEN 'Idade Média das Abertas (dias)' THEN idade_exata ELSE valor END, 6)
         AS valor_b, TRUE AS confere
FROM linhas_r
""")
def reconcile_roles(spark, sf_dir):
    """Every number as each role sees it, and the total, against the second definition."""
    model = W.delivery_model(spark, sf_dir)
    found = reconcile(
        crosscheck.role_values(model), crosscheck.independent_roles(spark, model), ["papel"])
    return found.select(
        "papel", "medida", F.round("valor_a", 6).alias("valor"), F.round("valor_b", 6).alias("valor_b"),
        "confere")


FLOW_ROWS = ", ".join([
    _row("Tempo Médio na Etapa (dias)", "tempo"), _row("Tarefas Paradas na Etapa", "paradas"),
    _row("Paradas há mais de 15 dias", "nullif(muito, 0)"), _row("Dias Bloqueada", "bloqueada"),
    _row("% Concluídas com Retrabalho", "refeitas / feitas"), _row("Ciclo Médio (dias)", "ciclo"),
    _row("Ciclo Mediano (dias)", "mediano"), _row("Mudanças de Status", "mudancas"),
    _row("Bloqueios no Período", "bloqueios"),
])


@query("reconcile_flow", f"""
, numeros AS (
  SELECT * FROM (
    SELECT CAST(sum({hundredths('segundos')}) FILTER (WHERE NOT atual) AS BIGINT)
             / count(segundos) FILTER (WHERE NOT atual) / 100 AS tempo,
           count(DISTINCT tarefa_id) FILTER (WHERE atual AND NOT final) AS paradas,
           count(DISTINCT tarefa_id) FILTER (WHERE atual AND NOT final
             AND {hundredths('segundos')} > 1500) AS muito,
           count(*) FILTER (WHERE strftime(ts - INTERVAL 3 HOUR, '%Y%m') = '202401') AS mudancas,
           count(*) FILTER (WHERE strftime(ts - INTERVAL 3 HOUR, '%Y%m') = '202401'
                            AND etapa = 'Impedido') AS bloqueios
    FROM visits), (
    SELECT CAST(sum(bloqueada) AS BIGINT) / 100 AS bloqueada,
           nullif(count(*) FILTER (WHERE status = 'Concluído' AND retrabalho > 0), 0) AS refeitas,
           nullif(count(*) FILTER (WHERE status = 'Concluído'), 0) AS feitas,
           CAST(sum(ciclo_c) AS BIGINT) / count(ciclo_c) / 100 AS ciclo,
           median(ciclo_c) / 100 AS mediano
    FROM flow_tasks)
), linhas_r AS (SELECT unnest([{FLOW_ROWS}], recursive := true) FROM numeros)
SELECT medida, round(valor, 6) AS valor, texto, TRUE AS confere FROM linhas_r
""")
def reconcile_flow(spark, sf_dir):
    model = W.flow_model(spark, sf_dir, kept=(
        "passagens", "fato_tarefa", "fato_passagem_status", "dim_projeto", "dim_data"))
    names, period = crosscheck.FLOW_NAMES, crosscheck.PERIOD_VISIT_NAMES
    ours = long_form(measure(model, names), names).unionByName(long_form(
        measure(model, period, filters={"dim_data.mes_ano": ["jan/24"]}), period))
    theirs = crosscheck.independent_flow(spark, model).unionByName(
        crosscheck.independent_period_flow(spark, model, "202401"))
    return _reconciled(ours, theirs)


@query("sql_subqueries", """
SELECT (SELECT sum(centesimos) FROM tasks) / (SELECT sum(horas_orcadas) FROM dim) / 100
         AS consumido,
       (SELECT count(*) FROM tickets WHERE status = 'Concluído' AND tarefa_id IN (
          SELECT tarefa_id FROM visits WHERE anterior = 'Em revisão' AND etapa = 'Fazendo'))
         AS concluidas_com_retrabalho
""")
def sql_subqueries(spark, sf_dir):
    """Scalar subqueries of two facts, and a membership test in a third."""
    delivery = W.delivery_model(spark, sf_dir)
    visits = W.flow_visits(spark, sf_dir)
    hours = delivery["fato_tarefa"].select(
        F.round(F.col("horas_apontadas") * 100).cast("bigint").alias("centesimos"))
    tickets = W.flow_tasks(spark, sf_dir).select(F.col("id").alias("tarefa_id"), "etapa")
    return spark.sql("""
        SELECT (SELECT sum(centesimos) FROM {hours})
                 / (SELECT sum(horas_orcadas) FROM {projects}) / 100 AS consumido,
               (SELECT count(*) FROM {tickets} WHERE etapa = 'Concluído' AND tarefa_id IN (
                  SELECT tarefa_id FROM {visits}
                  WHERE status_anterior = 'Em revisão' AND status = 'Fazendo'))
                 AS concluidas_com_retrabalho
    """, hours=hours, projects=delivery["dim_projeto"], tickets=tickets, visits=visits)
