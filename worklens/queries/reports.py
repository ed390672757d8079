"""The report's visuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.plans import reports
from worklens.queries.measures import MONTH, RUNNING, blank
from worklens.queries.registry import query
from worklens.sources import warehouse as W


@query("rpt_health", 'SELECT farol, count(*) AS "Projetos" FROM dim GROUP BY farol')
def rpt_health(spark, sf_dir):
    return reports.health(W.delivery_model(spark, sf_dir))


@query("rpt_created_delivered", f"""
SELECT ano_mes, mes_ano, criadas AS "Tarefas Criadas", entregues AS "Tarefas Entregues"
FROM (SELECT CAST(year(data_criacao) * 100 + month(data_criacao) AS INTEGER) AS ano_mes,
             {MONTH.format('data_criacao')} AS mes_ano, count(*) AS criadas
      FROM tasks WHERE year(data_criacao) IN (2000, 2001) GROUP BY 1, 2)
FULL JOIN (
      SELECT CAST(year(data_conclusao) * 100 + month(data_conclusao) AS INTEGER) AS ano_mes,
             {MONTH.format('data_conclusao')} AS mes_ano, count(*) AS entregues
      FROM tasks WHERE year(data_conclusao) IN (2000, 2001) GROUP BY 1, 2)
USING (ano_mes, mes_ano) ORDER BY ano_mes
""")
def rpt_created_delivered(spark, sf_dir):
    return reports.created_delivered(W.delivery_model(spark, sf_dir), [2000, 2001])


@query("rpt_risk", """
SELECT DISTINCT projeto, CAST(dias_atraso AS INTEGER) AS dias_atraso
FROM dim WHERE situacao_prazo = 'Atrasado' ORDER BY dias_atraso DESC, projeto
""")
def rpt_risk(spark, sf_dir):
    return reports.at_risk(W.delivery_model(spark, sf_dir))


@query("rpt_by_portfolio", f"""
SELECT portfolio, {blank(RUNNING)} AS "Projetos Ativos",
       {blank("situacao_prazo = 'Atrasado'")} AS "Projetos Atrasados"
FROM dim GROUP BY portfolio
""")
def rpt_by_portfolio(spark, sf_dir):
    return reports.by_portfolio(W.delivery_model(spark, sf_dir))


@query("rpt_stage_kanban", 'SELECT etapa, count(*) AS "Projetos" FROM dim GROUP BY etapa')
def rpt_stage_kanban(spark, sf_dir):
    return reports.stage_board(W.delivery_model(spark, sf_dir))


@query("rpt_projects", """
SELECT projeto, portfolio, etapa, farol, CAST(dias_atraso AS INTEGER) AS dias_atraso,
       nullif(CAST(sum(feitas) AS BIGINT), 0) / CAST(sum(n) AS BIGINT) AS concluido
FROM dim LEFT JOIN (
  SELECT projeto_id, count(*) AS n, count(*) FILTER (WHERE status = 'Concluído') AS feitas
  FROM tasks GROUP BY projeto_id) USING (projeto_id)
GROUP BY projeto, portfolio, etapa, farol, dias_atraso
""")
def rpt_projects(spark, sf_dir):
    return reports.project_table(W.delivery_model(spark, sf_dir))


@query("rpt_stalled", """
SELECT CASE etapa WHEN 'Backlog' THEN 1 WHEN 'A fazer' THEN 2 WHEN 'Fazendo' THEN 3
       WHEN 'Impedido' THEN 4 ELSE 5 END AS ordem_etapa, etapa AS status,
       count(DISTINCT tarefa_id) AS "Tarefas Paradas na Etapa"
FROM visits WHERE atual AND NOT final GROUP BY etapa ORDER BY ordem_etapa
""")
def rpt_stalled(spark, sf_dir):
    return reports.stalled(W.flow_model(spark, sf_dir))


@query("rpt_overdue", """
SELECT DISTINCT titulo, s_name AS pessoa, CAST(dias_atraso AS INTEGER) AS dias_atraso
FROM tasks LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = responsavel_id
WHERE situacao_prazo = 'Vencida' ORDER BY dias_atraso DESC, titulo, pessoa
""")
def rpt_overdue(spark, sf_dir):
    return reports.overdue(W.delivery_model(spark, sf_dir))


@query("rpt_overdue_sliced", """
SELECT DISTINCT titulo, s_name AS pessoa, CAST(dias_atraso AS INTEGER) AS dias_atraso
FROM tasks LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = responsavel_id
WHERE situacao_prazo = 'Vencida' AND projeto_id IN (
  SELECT projeto_id FROM dim WHERE portfolio IN ('BUILDING', 'MACHINERY')
  AND status = 'Em execução')
ORDER BY dias_atraso DESC, titulo, pessoa
""")
def rpt_overdue_sliced(spark, sf_dir):
    return reports.overdue(W.delivery_model(spark, sf_dir), {
        "dim_projeto.portfolio": ["BUILDING", "MACHINERY"], "dim_projeto.status": ["Em execução"]})


@query("rpt_kpis", """
SELECT (SELECT count(*) FROM dim WHERE status IN ('Em execução', 'Planejamento'))
         AS projetos_ativos,
       (SELECT replace(format('{:,}', count(*)), ',', '.') || ' vieram de ideias' FROM dim
        WHERE origem = 'Ideia') AS ideias,
       (SELECT count(*) FROM dim WHERE situacao_prazo = 'Atrasado') AS projetos_atrasados,
       (SELECT count(*) FILTER (WHERE situacao_prazo = 'Concluída no prazo')
          / count(*) FILTER (WHERE situacao_prazo IN ('Concluída no prazo',
                                                      'Concluída com atraso')) FROM tasks)
         AS no_prazo,
       (SELECT 'R$ ' || replace(format('{:.1f}', round(sum(orcamento) / 1000000, 1)), '.', ',')
          || ' mi' FROM dim) AS orcamento,
       (SELECT CAST(CAST(round((SELECT sum(centesimos) FROM tasks)
          / (SELECT sum(horas_orcadas) FROM dim)) AS INTEGER) AS VARCHAR)
          || '% das horas orçadas já usadas') AS consumo,
       (SELECT count(*) FROM tasks WHERE aberta) AS tarefas_abertas,
       (SELECT count(*) FROM tasks WHERE situacao_prazo = 'Vencida') AS tarefas_vencidas,
       (SELECT count(*) FILTER (WHERE status = 'Concluído') / count(*) FROM tasks)
         AS parte_concluida,
       (SELECT CAST(sum(date_diff('day', data_criacao, data_conclusao)) * 100 AS BIGINT)
          / count(data_conclusao) / 100 FROM tasks) AS lead_time
""")
def rpt_kpis(spark, sf_dir):
    """Both rows of cards, their values and context lines, as one row."""
    names = {
        "Projetos Ativos": "projetos_ativos", "Contexto Projetos de Ideias": "ideias",
        "Projetos Atrasados": "projetos_atrasados", "% Entregues no Prazo": "no_prazo",
        "Texto Orçamento": "orcamento", "Contexto Orçamento Consumido": "consumo",
        "Tarefas Abertas": "tarefas_abertas", "Tarefas Vencidas": "tarefas_vencidas",
        "% Tarefas Concluídas": "parte_concluida", "Lead Time Médio (dias)": "lead_time",
    }
    row = reports.cards(W.delivery_model(spark, sf_dir))
    return row.select(*[F.col(f"`{name}`").alias(alias) for name, alias in names.items()])


@query("rollup_by_portfolio", """
SELECT d.portfolio, count(DISTINCT d.projeto_id) AS projetos, count(t.tarefa_id) AS tarefas,
       count(*) FILTER (WHERE t.aberta) AS abertas
FROM dim d LEFT JOIN tasks t ON t.projeto_id = d.projeto_id GROUP BY d.portfolio
""")
def rollup_by_portfolio(spark, sf_dir):
    return reports.portfolio_totals(W.delivery_model(spark, sf_dir))
