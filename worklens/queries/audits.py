"""History audits, point-in-time state and attributes derived from tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.functions import labels as L
from worklens.operators import audit as A
from worklens.operators import pointintime as P
from worklens.queries.registry import query
from worklens.sources import warehouse as W
from worklens.sources.warehouse import DELIVERY_REF, table


@query("audit_duplicates", """
SELECT 'lineitem' AS tabela,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       'id duplicado' AS problema
FROM lineitem GROUP BY 2 HAVING count(*) > 1
UNION ALL
SELECT 'part', p_name, 'p_name duplicado' FROM part GROUP BY p_name HAVING count(*) > 1
""")
def audit_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"))
    return A.duplicates(lines, "lineitem").unionByName(
        A.duplicates(table(spark, sf_dir, "part"), "part", "p_name"))


def _tampered_history(spark, sf_dir):
    """The event history with some predecessors and times overwritten."""
    number = F.col("id").cast("bigint")
    moves = W.flow_moves_with_previous(spark, sf_dir)
    return moves.withColumns({
        "etapa_anterior": F.when(number % 97 == 0, F.lit("Arquivada"))
        .otherwise(F.col("etapa_anterior")),
        "ocorrido_em": F.when(number % 101 == 0, F.col("ocorrido_em") - F.expr("INTERVAL 9 DAYS"))
        .otherwise(F.col("ocorrido_em")),
    })


SQL_TAMPERED = """
, alterado AS (
  SELECT id, tarefa_id, etapa,
         CASE WHEN CAST(id AS BIGINT) % 97 = 0 THEN 'Arquivada' ELSE anterior END AS anterior,
         CASE WHEN CAST(id AS BIGINT) % 101 = 0 THEN ts - INTERVAL 9 DAY ELSE ts END AS ts
  FROM visits
), passos AS (
  SELECT *, lag(etapa) OVER w AS etapa_antes, lag(ts) OVER w AS ts_antes
  FROM alterado WINDOW w AS (PARTITION BY tarefa_id ORDER BY id)
), pontas AS (
  SELECT tarefa_id, arg_min(ts, id) AS primeiro, arg_max(ts, id) AS ultimo,
         arg_max(etapa, id) AS etapa
  FROM alterado GROUP BY tarefa_id
)
"""


@query("audit_history", SQL_TAMPERED + """
SELECT 'movimentacoes' AS tabela, id, 'histórico pula etapa' AS problema FROM passos
WHERE ts_antes IS NOT NULL AND anterior IS DISTINCT FROM etapa_antes
UNION ALL SELECT 'movimentacoes', id, 'histórico fora de ordem' FROM passos WHERE ts <= ts_antes
UNION ALL SELECT 'movimentacoes', id, 'histórico não começa na criação' FROM passos
WHERE ts_antes IS NULL AND anterior IS NOT NULL
UNION ALL SELECT 'tarefas', t.tarefa_id, 'status atual difere do último evento'
FROM tickets t JOIN pontas p USING (tarefa_id) WHERE t.status <> p.etapa
UNION ALL SELECT 'tarefas', t.tarefa_id, 'datas da tarefa não batem com o histórico'
FROM tickets t JOIN pontas p USING (tarefa_id) WHERE t.criada <> primeiro OR t.ultima <> ultimo
""")
def audit_history(spark, sf_dir):
    """Each event against the one before it, and each ticket against its first and last event."""
    moves = _tampered_history(spark, sf_dir)
    return A.history_steps(moves).unionByName(
        A.history_matches_tasks(W.flow_tasks(spark, sf_dir), moves))


@query("audit_coherence", """
SELECT 'tarefas' AS tabela, tarefa_id AS id, 'data de conclusão incoerente com o status' AS problema
FROM tasks WHERE o_orderkey % 50 = 0 AND status = 'Concluído'
UNION ALL SELECT 'tarefas', tarefa_id, 'horas negativas' FROM tasks
WHERE o_orderkey % 40 = 1 AND centesimos IS NOT NULL AND aberta
UNION ALL SELECT 'tarefas', tarefa_id, 'data depois da referência' FROM tasks
WHERE coalesce(data_conclusao, data_criacao) + CASE WHEN o_orderkey % 60 = 2 THEN 400 ELSE 0 END
      > DATE '2001-08-31'
UNION ALL SELECT 'projetos', projeto_id, 'data de conclusão incoerente com o status' FROM projects
WHERE (data_conclusao IS NOT NULL) <> (situacao = 'Concluído')
UNION ALL SELECT 'projetos', projeto_id, 'situação ou farol desconhecido' FROM projects
WHERE farol = 'Encerrado' AND k % 3 = 0
""")
def audit_coherence(spark, sf_dir):
    key = F.col("id").cast("bigint")
    tasks = W.delivery_tasks(spark, sf_dir).withColumns({
        "concluida_em": F.when(key % 50 != 0, F.col("concluida_em")),
        "horas_apontadas": F.when(key % 40 == 1, -F.col("horas_apontadas"))
        .otherwise(F.col("horas_apontadas")),
        "atualizado_em": F.when(key % 60 == 2, F.col("atualizado_em") + F.expr("INTERVAL 400 DAYS"))
        .otherwise(F.col("atualizado_em")),
    })
    projects = W.projects(spark, sf_dir).withColumn(
        "farol", F.when((F.col("farol") == "Encerrado") & (key % 3 == 0), "Roxo")
        .otherwise(F.col("farol")))
    return A.task_coherence(tasks, DELIVERY_REF, "UTC").unionByName(
        A.project_coherence(projects))


def _moment(text: str):
    return F.lit(text).cast("timestamp")


@query("state_as_of", """
SELECT tarefa_id, arg_max(etapa, (ts, id)) AS status, min(ts) AS criada_em,
       max(ts) AS atualizado_em, count(*) AS qtd_passagens
FROM moves WHERE ts <= TIMESTAMP '2024-01-15 23:59:59' GROUP BY tarefa_id
""")
def state_as_of(spark, sf_dir):
    return P.state_as_of(W.flow_moves(spark, sf_dir), _moment("2024-01-15 23:59:59"))


@query("cut_stability", """
, antes AS (
  SELECT tarefa_id, arg_max(etapa, (ts, id)) AS status, min(ts) AS criada, max(ts) AS atualizada
  FROM moves WHERE ts <= TIMESTAMP '2024-01-10' GROUP BY tarefa_id
), depois AS (
  SELECT tarefa_id, arg_max(etapa, (ts, id)) AS status, min(ts) AS criada, max(ts) AS atualizada
  FROM moves WHERE ts <= TIMESTAMP '2024-01-20' AND CAST(id AS BIGINT) % 11 <> 0
  GROUP BY tarefa_id
)
SELECT tarefa_id, problema FROM (
  SELECT a.tarefa_id, CASE WHEN d.status IS NULL THEN 'tarefa sumiu'
         WHEN a.criada <> d.criada THEN 'criação mudou'
         WHEN (a.status <> d.status OR a.atualizada <> d.atualizada)
              AND d.atualizada <= TIMESTAMP '2024-01-10' THEN 'mudou sem atualização posterior'
         END AS problema
  FROM antes a LEFT JOIN depois d USING (tarefa_id)) WHERE problema IS NOT NULL
""")
def cut_stability(spark, sf_dir):
    """Two cuts of a history that lost one event in eleven: the audit names what changed."""
    moves = W.flow_moves(spark, sf_dir)
    lossy = moves.where(F.col("id").cast("bigint") % 11 != 0)
    cut = _moment("2024-01-10")
    return P.cut_differences(
        P.state_as_of(moves, cut), P.state_as_of(lossy, _moment("2024-01-20")), cut)


@query("history_labels", """
SELECT tarefa_id, CASE WHEN agora AND retrabalho THEN 'Bloqueada, Retrabalho'
       WHEN agora THEN 'Bloqueada' WHEN retrabalho THEN 'Retrabalho' ELSE '' END AS etiquetas
FROM (SELECT tarefa_id, bool_or(atual AND etapa = 'Impedido') AS agora,
             bool_or(coalesce(anterior, '') = 'Em revisão' AND etapa = 'Fazendo') AS retrabalho
      FROM visits GROUP BY tarefa_id)
""")
def history_labels(spark, sf_dir):
    labels = P.history_labels(W.flow_moves_with_previous(spark, sf_dir))
    return labels.select("tarefa_id", F.array_join("etiquetas", ", ").alias("etiquetas"))


SQL_PROGRESS = """
, progresso AS (
  SELECT projeto_id, avg(CAST(status = 'Concluído' AS INTEGER)) AS parte,
         bool_and(status IN ('Backlog', 'A fazer')) AS parado,
         bool_and(status IN ('Concluído', 'Arquivada')) AS encerrado
  FROM tasks GROUP BY projeto_id)
"""


@query("project_stage_from_tasks", SQL_PROGRESS + """
SELECT projeto_id, CASE WHEN k % 34 = 0 THEN 'Arquivado' WHEN k % 17 = 0 THEN 'Ativo'
         WHEN coalesce(parado, TRUE) THEN 'Ativo'
         WHEN encerrado AND data_inicio + 800 <= DATE '2001-08-31' THEN 'Concluído'
         ELSE 'Ativo' END AS situacao,
       CASE WHEN k % 17 = 0 THEN 'Execução' WHEN coalesce(parado, TRUE) THEN 'Planejamento'
         WHEN encerrado AND data_inicio + 800 <= DATE '2001-08-31' THEN 'Concluído'
         WHEN parte >= 0.8 THEN 'Implantação' ELSE 'Execução' END AS etapa
FROM projects LEFT JOIN progresso USING (projeto_id)
""")
def project_stage_from_tasks(spark, sf_dir):
    progress = P.task_progress(W.delivery_tasks(spark, sf_dir))
    projects = W.projects(spark, sf_dir).select(F.col("id").alias("projeto_id"), "inicio")
    key = F.col("projeto_id").cast("bigint")
    state, stage = P.project_stage(
        key % 17 == 0, key % 34 == 0, F.date_add("inicio", 800), F.lit(DELIVERY_REF))
    return projects.join(progress, "projeto_id", "left").select(
        "projeto_id", state.alias("situacao"), stage.alias("etapa"))


@query("traffic_light", SQL_PROGRESS + """
SELECT projeto_id, CASE WHEN situacao <> 'Ativo' THEN 'Encerrado'
         WHEN data_limite < DATE '2001-08-31' THEN 'Vermelho'
         WHEN espera THEN 'Amarelo'
         WHEN date_diff('day', data_inicio, DATE '2001-08-31')
                / greatest(date_diff('day', data_inicio, data_limite), 1)
                - coalesce(parte, 0) > 0.05 THEN 'Amarelo'
         ELSE 'Verde' END AS farol
FROM projects LEFT JOIN progresso USING (projeto_id)
""")
def traffic_light(spark, sf_dir):
    progress = P.task_progress(W.delivery_tasks(spark, sf_dir))
    projects = W.projects(spark, sf_dir).withColumnRenamed("id", "projeto_id")
    light = L.traffic_light(
        "situacao", "etiquetas", "inicio", "limite", "parte_concluida", DELIVERY_REF)
    return projects.join(
        progress.select("projeto_id", "parte_concluida"), "projeto_id", "left"
    ).select("projeto_id", light.alias("farol"))


@query("budget_rollup", """
SELECT projeto_id, CAST(portfolio_id AS INTEGER) AS portfolio_id,
       CAST(horas AS INTEGER) AS horas_orcadas,
       CAST(horas * (100 + 10 * portfolio_id) AS DOUBLE) AS orcamento
FROM (
  SELECT p.projeto_id, list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD',
           'MACHINERY'], p.portfolio) AS portfolio_id,
         ceil(coalesce(sum(t.estimativa) FILTER (WHERE t.data_criacao <= p.data_inicio + 800), 0)
              * CAST(1.1 AS DOUBLE) / 10) * 10 AS horas
  FROM projects p LEFT JOIN tasks t ON t.projeto_id = p.projeto_id
  GROUP BY p.projeto_id, p.portfolio)
""")
def budget_rollup(spark, sf_dir):
    """Budget hours from the tasks of the original scope, priced at the portfolio's rate."""
    scope = W.projects(spark, sf_dir).select(
        F.col("id").alias("projeto_id"), "portfolio_id",
        F.date_add("inicio", 800).cast("timestamp").alias("escopo_ate"))
    rates = W.portfolios(spark, sf_dir).select(
        F.col("id").alias("portfolio_id"), (100 + 10 * F.col("id")).alias("custo_hora"))
    return P.budget_rollup(W.delivery_tasks(spark, sf_dir), scope, rates)


@query("audit_orphans", """
SELECT 'pedidos' AS tabela, CAST(o_orderkey AS VARCHAR) AS id, 'pessoa_id inexistente' AS problema
FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def audit_orphans(spark, sf_dir):
    """Orders whose owner is no supplier."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pessoa_id"))
    people = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return A.orphans(orders, "pessoa_id", people, "pedidos")
