"""Stage visits, their rollup, joins around them and times per task."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.functions import times as T
from worklens.operators.history import history_rollup
from worklens.operators.skew import skew_join
from worklens.plans.checks import gold_checks
from worklens.queries.registry import query
from worklens.queries.sql import FLOW_END, days, hundredths
from worklens.sources import warehouse as W
from worklens.sources.warehouse import table


@query("stage_visits", """
SELECT id AS passagem_id, tarefa_id, CAST(sequencia AS INTEGER) AS sequencia,
       anterior AS status_anterior, etapa AS status, ts - INTERVAL 3 HOUR AS entrada_em,
       saida - INTERVAL 3 HOUR AS saida_em, segundos AS segundos_na_etapa,
       atual AS etapa_atual, final AS etapa_final
FROM visits
""")
def stage_visits(spark, sf_dir):
    """Next and previous move, position and stay of every move of a ticket, in one window pass."""
    return W.flow_visits(spark, sf_dir).select(
        "passagem_id", "tarefa_id", "sequencia", "status_anterior", "status", "entrada_em",
        "saida_em", "segundos_na_etapa", "etapa_atual", "etapa_final")


@query("stage_days", f"""
SELECT id AS passagem_id, etapa AS status, {days('segundos')} AS dias_na_etapa FROM visits
""")
def stage_days(spark, sf_dir):
    return W.flow_visits(spark, sf_dir).select("passagem_id", "status", "dias_na_etapa")


@query("history_rollup", """
SELECT tarefa_id, inicio AS inicio_execucao_utc, bloqueios AS qtd_bloqueios,
       bloqueada AS centesimos_bloqueada, retrabalho AS qtd_retrabalho,
       ultima AS ultima_mudanca_utc, passagens AS qtd_passagens FROM rollup
""")
def history_rollup_query(spark, sf_dir):
    return history_rollup(W.flow_visits(spark, sf_dir))


@query("join_inner", """
SELECT v.id AS passagem_id, v.tarefa_id, t.projeto_id, v.etapa AS status
FROM visits v JOIN tickets t ON t.tarefa_id = v.tarefa_id
""")
def join_inner(spark, sf_dir):
    """Visits with their ticket's project; hot tickets are salted, not sent to one task."""
    owner = W.flow_tasks(spark, sf_dir).select(F.col("id").alias("tarefa_id"), "projeto_id")
    visits = W.flow_visits(spark, sf_dir).select("passagem_id", "tarefa_id", "status")
    return skew_join(visits, owner, "tarefa_id", "inner", ["passagem_id"],
                     counted=W.flow_moves(spark, sf_dir))


@query("join_left_rollup", """
SELECT o_orderkey, h.estimativa AS estimativa_horas, h.centesimos / 100 AS horas_apontadas
FROM orders LEFT JOIN hours h ON h.l_orderkey = o_orderkey
""")
def join_left_rollup(spark, sf_dir):
    """Orders with the hours rolled up from their lines; orders without lines stay."""
    hours = W.delivery_hours(spark, sf_dir).drop("responsavel_id")
    return table(spark, sf_dir, "orders").select("o_orderkey").join(hours, "o_orderkey", "left")


@query("join_broadcast_dims", """
SELECT c_custkey, c_mktsegment AS portfolio, s_name AS gerente, n_name AS pais
FROM customer LEFT JOIN supplier ON s_suppkey = c_nationkey
LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def join_broadcast_dims(spark, sf_dir):
    """Projects with portfolio, manager and country names; the engine broadcasts by real size."""
    portfolios = W.portfolios(spark, sf_dir).select(
        F.col("id").alias("portfolio_id"), F.col("nome").alias("portfolio"))
    managers = W.people(spark, sf_dir).select(
        F.col("id").alias("gerente_id"), F.col("nome").alias("gerente"))
    countries = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("gerente_id"), F.col("n_name").alias("pais"))
    return (
        W.projects(spark, sf_dir)
        .select(F.col("id").cast("bigint").alias("c_custkey"), "portfolio_id", "gerente_id")
        .join(portfolios, "portfolio_id", "left")
        .join(managers, "gerente_id", "left")
        .join(countries, "gerente_id", "left")
        .select("c_custkey", "portfolio", "gerente", "pais")
    )


@query("join_semi", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def join_semi(spark, sf_dir):
    """Lines whose order survives a filter."""
    kept = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.join(kept, "l_orderkey", "left_semi")


@query("join_anti", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def join_anti(spark, sf_dir):
    """Orders without a line. Line keys are reduced first, so an order with very many is one row."""
    with_lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        with_lines, "o_orderkey", "left_anti")


@query("current_visit_match", """
SELECT t.tarefa_id, t.status, v.etapa AS status_passagem, t.status = v.etapa AS confere
FROM tickets t JOIN visits v ON v.tarefa_id = t.tarefa_id AND v.atual AND v.ts >= t.criada
""")
def current_visit_match(spark, sf_dir):
    """Tickets with their current visit: equality on the key, the rest as a residual test."""
    current = W.flow_visits(spark, sf_dir).where("etapa_atual").select(
        "tarefa_id", F.col("status").alias("status_passagem"), "entrada_utc")
    tickets = W.flow_tasks(spark, sf_dir).select(
        F.col("id").alias("tarefa_id"), F.col("etapa").alias("status"), "criada_em")
    return (
        tickets.join(current, "tarefa_id").where("entrada_utc >= criada_em")
        .select("tarefa_id", "status", "status_passagem",
                F.expr("status = status_passagem").alias("confere"))
    )


@query("having_not_one", """
SELECT user_id, event_type, count(*) AS vezes FROM events GROUP BY ALL HAVING count(*) <> 1
""")
def having_not_one(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("vezes")).where("vezes <> 1")


@query("lead_cycle", """
SELECT tarefa_id, lead_c / 100 AS lead_time_dias, ciclo_c / 100 AS ciclo_dias FROM flow_tasks
""")
def lead_cycle(spark, sf_dir):
    facts = W.flow_model(spark, sf_dir)["fato_tarefa"]
    return facts.select("tarefa_id", "lead_time_dias", "ciclo_dias")


@query("open_age", f"""
SELECT tarefa_id,
       CASE WHEN aberta THEN {hundredths(f"date_diff('second', criada, {FLOW_END})")} / 100 END
         AS idade_dias,
       CASE WHEN aberta THEN {hundredths(f"date_diff('second', ultima, {FLOW_END})")} / 100 END
         AS dias_na_etapa_atual
FROM tickets
""")
def open_age(spark, sf_dir):
    facts = W.flow_model(spark, sf_dir)["fato_tarefa"]
    return facts.select("tarefa_id", "idade_dias", "dias_na_etapa_atual")


@query("fact_tasks", """
SELECT tarefa_id, projeto_id, titulo, tipo, prioridade, status, data_criacao, data_conclusao,
       data_limite, estimativa AS estimativa_horas, centesimos / 100 AS horas_apontadas, aberta,
       situacao_prazo, CAST(dias_atraso AS INTEGER) AS dias_atraso,
       CASE WHEN status = 'Concluído' THEN
         CAST(date_diff('day', data_criacao, data_conclusao) AS DOUBLE) END AS lead_time_dias
FROM tasks
""")
def fact_tasks(spark, sf_dir):
    """The task fact of the order view."""
    return W.delivery_model(spark, sf_dir)["fato_tarefa"].select(
        "tarefa_id", "projeto_id", "titulo", "tipo", "prioridade", "status", "data_criacao",
        "data_conclusao", "data_limite", "estimativa_horas", "horas_apontadas", "aberta",
        "situacao_prazo", "dias_atraso", "lead_time_dias")


@query("dim_projects", """
SELECT projeto_id, projeto, portfolio, s_name AS gerente, status, etapa, situacao, farol, origem,
       data_inicio, data_limite, data_conclusao, horas_orcadas, orcamento,
       CAST(dias_planejados AS INTEGER) AS dias_planejados, situacao_prazo,
       CAST(dias_atraso AS INTEGER) AS dias_atraso
FROM dim LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = gerente_id
""")
def dim_projects(spark, sf_dir):
    """The project dimension of the order view."""
    return W.delivery_model(spark, sf_dir)["dim_projeto"].select(
        "projeto_id", "projeto", "portfolio", "gerente", "status", "etapa", "situacao", "farol",
        "origem", "data_inicio", "data_limite", "data_conclusao", "horas_orcadas", "orcamento",
        "dias_planejados", "situacao_prazo", "dias_atraso")


@query("gold_checks", """
, k AS (SELECT *, CAST(tarefa_id AS BIGINT) AS n FROM flow_tasks)
SELECT 'toda tarefa tem projeto' AS checagem, count(*) AS violacoes FROM k
WHERE n % 37 = 0 OR projeto_id NOT IN (SELECT projeto_id FROM flow_dim)
UNION ALL SELECT 'todo responsável existe', count(*) FROM k
WHERE n % 41 = 0 OR responsavel_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)
UNION ALL SELECT 'status da tarefa = última passagem',
  CAST(coalesce(sum(CASE WHEN n % 47 = 0 THEN 2 ELSE 1 END), 0) AS BIGINT)
FROM k WHERE n % 43 = 0 AND status <> 'Backlog'
UNION ALL SELECT 'uma etapa atual por tarefa', count(*) FROM k WHERE n % 47 = 0
UNION ALL SELECT 'tempos não negativos', count(*) FROM k
WHERE n % 53 = 0 OR ciclo_c < 0 OR lead_c < 0 OR bloqueada < 0
UNION ALL SELECT 'ciclo ≤ lead time', count(*) FROM k
WHERE CASE WHEN n % 29 = 0 THEN lead_c IS NOT NULL ELSE ciclo_c > lead_c END
UNION ALL SELECT 'calendário cobre todas as datas', count(*) FROM k
WHERE n % 61 = 0 OR year(data_criacao) < (SELECT min(year(data_inicio)) FROM flow_dim)
""")
def gold_checks_query(spark, sf_dir):
    """Every check on a model tampered with in seven ways, so that each has something to find."""
    model = W.flow_model(spark, sf_dir)
    key = F.col("tarefa_id").cast("bigint")

    def tasks():
        def changed(name, every, value):
            return F.when(key % every == 0, value).otherwise(F.col(name))

        return model["fato_tarefa"].withColumns({
            "projeto_id": changed("projeto_id", 37, F.lit("sem projeto")),
            "responsavel_id": changed("responsavel_id", 41, F.lit("ninguém")),
            "status": changed("status", 43, F.lit("Backlog")),
            "dias_bloqueada": changed("dias_bloqueada", 53, F.lit(-1.0)),
            "ciclo_dias": changed("ciclo_dias", 29, F.col("lead_time_dias") + 1),
            "data_criacao": changed("data_criacao", 61, F.add_months("data_criacao", -1200)),
        })

    def visits():
        facts = model["fato_passagem_status"]
        twice = F.col("etapa_atual") & (key % 47 == 0)
        copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return facts.withColumn("_copia", F.explode(copies)).drop("_copia")

    return gold_checks(model.replacing({
        "fato_tarefa": tasks, "fato_passagem_status": visits,
        "dim_data": lambda: model["dim_data"]}))


@query("weekly_flow", f"""
SELECT CAST(date_trunc('week', ts - INTERVAL 3 HOUR) AS DATE) AS semana_inicio, etapa AS status,
       count(*) AS passagens,
       CAST(coalesce(sum({hundredths('segundos')}) FILTER (WHERE NOT atual), 0) AS BIGINT)
         AS centesimos,
       count(segundos) FILTER (WHERE NOT atual) AS encerradas
FROM visits GROUP BY ALL
""")
def weekly_flow(spark, sf_dir):
    """Visits, time and blocks per week of entry and stage: window, aggregation and calendar."""
    stay = T.hundredths(F.col("segundos_na_etapa"))
    closed = ~F.col("etapa_atual")
    week = F.to_date(F.date_trunc("week", "data_entrada"))
    return W.flow_visits(spark, sf_dir).groupBy(week.alias("semana_inicio"), "status").agg(
        F.count(F.lit(1)).alias("passagens"),
        F.coalesce(F.sum(F.when(closed, stay)), F.lit(0)).alias("centesimos"),
        F.count(F.when(closed, F.col("segundos_na_etapa"))).alias("encerradas"),
    )


