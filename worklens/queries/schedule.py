"""Projects and tasks laid out on months."""

from __future__ import annotations

from datetime import date

from worklens.operators.spans import project_months, task_months
from worklens.plans.reports import schedule, schedule_matrix
from worklens.queries.registry import query
from worklens.sources import warehouse as W
from worklens.sources.warehouse import DELIVERY_REF

FIRST, LAST = date(1999, 1, 1), date(2000, 12, 31)
YEARS = [1999, 2000]
# fixed values: every month of the axis
MONTHS = [f"{m}/{y}" for y in ("99", "00") for m in
          "jan fev mar abr mai jun jul ago set out nov dez".split()]

SQL_MONTHS = """
, meses AS (
  SELECT CAST(m AS DATE) AS mes_inicio, last_day(CAST(m AS DATE)) AS mes_fim,
         CAST(year(m) * 100 + month(m) AS INTEGER) AS ano_mes,
         list_extract(['jan', 'fev', 'mar', 'abr', 'mai', 'jun', 'jul', 'ago', 'set', 'out',
                       'nov', 'dez'], CAST(month(m) AS INTEGER)) || '/' || strftime(m, '%y')
           AS mes_ano
  FROM (SELECT unnest(generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '2000-12-01',
                                      INTERVAL 1 MONTH)) AS m)
), barras AS (
  SELECT *, CASE WHEN data_conclusao IS NOT NULL THEN data_conclusao
                 WHEN status = 'Arquivado' THEN data_limite
                 ELSE greatest(coalesce(data_limite, DATE '2001-08-31'), DATE '2001-08-31') END
            AS fim,
         CASE WHEN situacao_prazo = 'Atrasado' THEN '#E44A5D'
              WHEN status = 'Arquivado' THEN '#364259' WHEN status = 'Concluído' THEN '#5D7398'
              WHEN status = 'Em espera' THEN '#33415E' ELSE '#4682F5' END AS cor
  FROM dim
), linhas AS (
  SELECT projeto_id, titulo, min(data_criacao) AS inicio,
         coalesce(max(data_conclusao), DATE '2001-08-31') AS fim, max(status) AS status,
         max(situacao_prazo) AS prazo
  FROM tasks GROUP BY projeto_id, titulo
), linhas_cor AS (
  SELECT *, CASE WHEN status = 'Concluído' THEN '#5D7398' WHEN status = 'Arquivada' THEN '#364259'
                 WHEN status = 'Impedido' THEN '#C4851A' WHEN prazo = 'Vencida' THEN '#E44A5D'
                 ELSE '#4682F5' END AS cor
  FROM linhas
), celulas AS (
  SELECT projeto_id, projeto, CAST(NULL AS VARCHAR) AS titulo, mes_inicio, ano_mes, mes_ano, cor
  FROM barras JOIN meses ON data_inicio <= mes_fim AND fim >= mes_inicio
  UNION ALL
  SELECT l.projeto_id, d.projeto, l.titulo, mes_inicio, ano_mes, mes_ano, l.cor
  FROM linhas_cor l JOIN meses ON inicio <= mes_fim AND fim >= mes_inicio
  JOIN dim d ON d.projeto_id = l.projeto_id
)
"""


@query("gantt_project_months", SQL_MONTHS + """
SELECT projeto_id, projeto, mes_inicio, cor FROM celulas WHERE titulo IS NULL
""")
def gantt_project_months(spark, sf_dir):
    projects = W.delivery_model(spark, sf_dir)["dim_projeto"]
    return project_months(projects, FIRST, LAST, DELIVERY_REF)


@query("gantt_task_months", SQL_MONTHS + """
SELECT projeto_id, titulo, mes_inicio, cor FROM celulas WHERE titulo IS NOT NULL
""")
def gantt_task_months(spark, sf_dir):
    """Bars use the whole life of a title, not the dates the axis shows."""
    tasks = W.delivery_model(spark, sf_dir)["fato_tarefa"]
    return task_months(tasks, FIRST, LAST, DELIVERY_REF)


def _schedule(spark, sf_dir, filters=None):
    """Hot projects are counted in the orders, not in the task facts made from them."""
    orders = W.table(spark, sf_dir, "orders").select(
        W.F.col("o_custkey").cast("string").alias("projeto_id"))
    return schedule(W.delivery_model(spark, sf_dir), DELIVERY_REF, YEARS, filters, orders)


@query("rpt_gantt", SQL_MONTHS + """
SELECT projeto_id, projeto, titulo, ano_mes, mes_ano, cor, ' ' AS cronograma FROM celulas
""")
def rpt_gantt(spark, sf_dir):
    return _schedule(spark, sf_dir)


@query("rpt_gantt_matrix", SQL_MONTHS + """
SELECT projeto, titulo, """ + ", ".join(
    f"max(cor) FILTER (WHERE mes_ano = '{m}') AS \"{m}\"" for m in MONTHS) + """
FROM celulas GROUP BY projeto, titulo
""")
def rpt_gantt_matrix(spark, sf_dir):
    return schedule_matrix(_schedule(spark, sf_dir), MONTHS)


@query("rpt_gantt_sliced", SQL_MONTHS + """
SELECT projeto_id, projeto, titulo, ano_mes, mes_ano, cor, ' ' AS cronograma
FROM celulas SEMI JOIN (SELECT projeto_id FROM dim WHERE portfolio IN ('BUILDING', 'MACHINERY')
                        AND status = 'Em execução') USING (projeto_id)
""")
def rpt_gantt_sliced(spark, sf_dir):
    """The slicers of the report's page: portfolio and project status."""
    return _schedule(spark, sf_dir, {"dim_projeto.portfolio": ["BUILDING", "MACHINERY"],
                                     "dim_projeto.status": ["Em execução"]})
