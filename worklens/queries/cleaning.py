"""Text, time and label columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.functions import labels as L
from worklens.functions import text as X
from worklens.functions import times as T
from worklens.operators.quarantine import first_violation, outside, row_rules
from worklens.queries.registry import query
from worklens.queries.sql import FLOW_END, days
from worklens.schemas import PRIORITIES, PRIORITY_UNKNOWN
from worklens.sources import warehouse as W
from worklens.sources.warehouse import DELIVERY_REF, FLOW_REF, table

SQL_SQUEEZE = r"nullif(trim(regexp_replace({0}, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' '), '')"


@query("text_normalize", f"""
SELECT doc_id, {SQL_SQUEEZE.format('text')} AS texto FROM documents
""")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.squeeze("text").alias("texto"))


@query("text_case", f"""
SELECT p_partkey, upper({SQL_SQUEEZE.format("' ' || p_name || ' '")}) AS sigla,
       lower({SQL_SQUEEZE.format('p_brand')}) AS email,
       upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS farol
FROM part
""")
def text_case(spark, sf_dir):
    padded = F.concat(F.lit(" "), "p_name", F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper(X.squeeze(padded)).alias("sigla"),
        F.lower(X.squeeze("p_brand")).alias("email"),
        X.capitalised("p_type").alias("farol"),
    )


@query("domain_default", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Alta' WHEN 1 THEN 'Crítica'
       WHEN 2 THEN 'Média' ELSE 'Não informada' END AS prioridade
FROM orders
""")
def domain_default(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    typed = (
        F.when(key == 0, "  alta ").when(key == 1, "CRÍTICA").when(key == 2, "\tmÉDIA\n")
        .when(key == 3, F.col("o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.in_domain(typed, PRIORITIES, PRIORITY_UNKNOWN).alias("prioridade"))


@query("domain_source_values", """
SELECT o_orderkey, CASE WHEN substr(o_orderpriority, 3) IN ('URGENT', 'HIGH', 'MEDIUM', 'LOW')
       THEN substr(o_orderpriority, 3, 1) || lower(substr(o_orderpriority, 4))
       ELSE 'Não informada' END AS prioridade
FROM orders
""")
def domain_source_values(spark, sf_dir):
    """Priorities as the source writes them, in a closed domain; what lies outside has the default."""
    written = F.substring_index("o_orderpriority", "-", -1)
    domain = ["Urgent", "High", "Medium", "Low"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.in_domain(written, domain, PRIORITY_UNKNOWN).alias("prioridade"))


@query("null_defaults", """
SELECT d.doc_id, coalesce(l.toxic = 0, TRUE) AS ativo,
       CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS qtd_etiquetas
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def null_defaults(spark, sf_dir):
    tagged = F.when(F.col("quality") == 1, F.array(F.lit("revisado")))
    rows = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id",
        F.coalesce(F.col("toxic") == 0, F.lit(True)).alias("ativo"),
        F.size(X.empty_labels(tagged)).alias("qtd_etiquetas"),
    )


@query("parse_times", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 26 HOUR + INTERVAL 30 MINUTE END
         AS criada_em,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS dia
FROM orders
""")
def parse_times(spark, sf_dir):
    """Local wall-clock text with an offset; one in seven is malformed and reads as NULL."""
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00-03:00"))
    written = F.when(F.col("o_orderkey") % 7 == 0, F.lit("31/02/x")).otherwise(stamp)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.instant(written).alias("criada_em"), T.day(written).alias("dia"))


@query("rule_violations", """
SELECT projeto_id, CASE WHEN data_limite < DATE '1999-06-01' THEN 'prazo antigo'
       WHEN orcamento < 0 THEN 'orçamento negativo'
       WHEN farol = 'Encerrado' THEN 'farol desconhecido' END AS motivo
FROM projects
""")
def rule_violations(spark, sf_dir):
    """First broken rule; a rule on a NULL deadline is undecided, hence not broken."""
    rules = [
        (F.col("limite") < F.lit("1999-06-01").cast("date"), "prazo antigo"),
        (F.col("orcamento") < 0, "orçamento negativo"),
        (outside("farol", ["Verde", "Amarelo", "Vermelho"]), "farol desconhecido"),
        *row_rules("projetos"),
    ]
    return W.projects(spark, sf_dir).select(
        F.col("id").alias("projeto_id"), first_violation(rules).alias("motivo"))


@query("task_deadline_state", "SELECT tarefa_id, situacao_prazo FROM tasks")
def task_deadline_state(spark, sf_dir):
    return W.delivery_tasks(spark, sf_dir).select(
        F.col("id").alias("tarefa_id"),
        L.task_deadline_state(
            "etapa", F.to_date("concluida_em"), "limite", DELIVERY_REF).alias("situacao_prazo"),
    )


@query("days_late_task", """
SELECT tarefa_id, CAST(dias_atraso AS INTEGER) AS dias_atraso FROM tasks
""")
def days_late_task(spark, sf_dir):
    return W.delivery_tasks(spark, sf_dir).select(
        F.col("id").alias("tarefa_id"),
        L.task_days_late(
            "etapa", F.to_date("concluida_em"), "limite", DELIVERY_REF).alias("dias_atraso"),
    )


def _with_status(spark, sf_dir):
    return W.projects(spark, sf_dir).select(
        F.col("id").alias("projeto_id"), "inicio", "limite", "concluido_em", "etiquetas",
        L.project_status("situacao", "etiquetas", "etapa").alias("status"),
    )


@query("project_status", "SELECT projeto_id, status FROM projects")
def project_status(spark, sf_dir):
    return _with_status(spark, sf_dir).select("projeto_id", "status")


@query("label_contains", "SELECT projeto_id, espera AS em_espera FROM projects")
def label_contains(spark, sf_dir):
    return W.projects(spark, sf_dir).select(
        F.col("id").alias("projeto_id"),
        F.array_contains("etiquetas", "Em espera").alias("em_espera"),
    )


@query("project_deadline_state", "SELECT projeto_id, situacao_prazo FROM dim")
def project_deadline_state(spark, sf_dir):
    return _with_status(spark, sf_dir).select(
        "projeto_id",
        L.project_deadline_state("status", "concluido_em", "limite", DELIVERY_REF)
        .alias("situacao_prazo"),
    )


@query("days_late_project", """
SELECT projeto_id, CAST(dias_atraso AS INTEGER) AS dias_atraso FROM dim
""")
def days_late_project(spark, sf_dir):
    return _with_status(spark, sf_dir).select(
        "projeto_id",
        L.project_days_late("status", "concluido_em", "limite", DELIVERY_REF)
        .alias("dias_atraso"),
    )


@query("schedule_elapsed", """
SELECT projeto_id, CAST(dias_planejados AS INTEGER) AS dias_planejados,
       CASE WHEN status IN ('Em execução', 'Planejamento') THEN
         (20000 * date_diff('day', data_inicio, DATE '2001-08-31') + dias_planejados)
           // (2 * dias_planejados) / 10000 END AS percentual_prazo_decorrido
FROM dim
""")
def schedule_elapsed(spark, sf_dir):
    return _with_status(spark, sf_dir).select(
        "projeto_id",
        F.datediff("limite", "inicio").alias("dias_planejados"),
        L.schedule_elapsed("status", "inicio", "limite", DELIVERY_REF)
        .alias("percentual_prazo_decorrido"),
    )


@query("effort_deviation_row", """
SELECT tarefa_id, CASE WHEN status = 'Concluído' THEN
       round(centesimos / 100 - estimativa, 1) END AS desvio_horas
FROM tasks
""")
def effort_deviation_row(spark, sf_dir):
    """Logged minus estimated hours of done tasks, one decimal."""
    return W.delivery_tasks(spark, sf_dir).select(
        F.col("id").alias("tarefa_id"),
        L.effort_deviation("etapa", "horas_apontadas", "estimativa_horas").alias("desvio_horas"),
    )


@query("durations", f"""
SELECT id, date_diff('second', ts, {FLOW_END}) AS segundos,
       {days(f"date_diff('second', ts, {FLOW_END})")} AS dias
FROM moves
""")
def durations(spark, sf_dir):
    end = T.end_of_day(FLOW_REF)
    return W.flow_moves(spark, sf_dir).select(
        "id",
        T.seconds_between("ocorrido_em", end).alias("segundos"),
        T.days_between("ocorrido_em", end).alias("dias"),
    )


@query("local_time", """
SELECT event_id, ts - INTERVAL 3 HOUR AS hora_local,
       CAST(ts - INTERVAL 3 HOUR AS DATE) AS dia_local
FROM events
""")
def local_time(spark, sf_dir):
    wall = T.local("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", wall.alias("hora_local"), F.to_date(wall).alias("dia_local"))


@query("stage_order", """
SELECT id, CASE etapa WHEN 'Backlog' THEN 1 WHEN 'A fazer' THEN 2 WHEN 'Fazendo' THEN 3
       WHEN 'Em revisão' THEN 5 WHEN 'Concluído' THEN 6 END AS ordem
FROM (SELECT id, nullif(etapa, 'Impedido') AS etapa FROM moves)
""")
def stage_order(spark, sf_dir):
    """Constant lookup; a NULL or unknown stage has no position."""
    return W.flow_moves(spark, sf_dir).select(
        "id", L.stage_order(F.nullif("etapa_nova", F.lit("Impedido"))).alias("ordem"))


@query("hash_bucket", """
SELECT c_custkey, CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) % 100 AS balde,
       CASE WHEN balde < 40 THEN 'Ideia' WHEN balde < 55 THEN 'Startup' ELSE 'Direto' END
         AS origem,
       CASE WHEN balde < 40 THEN 'IDE-' || CAST(1000 + n % 9000 AS VARCHAR)
            WHEN balde < 55 THEN 'STA-' || CAST(100 + n % 900 AS VARCHAR) END AS origem_id
FROM (SELECT *, CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) AS n FROM customer)
""")
def hash_bucket(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (L.hash_bucket("c_name") % 100).alias("balde"),
        L.origin("c_name").alias("origem"),
        L.origin_code("c_name").alias("origem_id"),
    )


@query("next_business_day", """
SELECT o_orderkey, CAST(o_orderdate AS DATE)
         + CAST(CASE isodow(o_orderdate) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS INTEGER)
         AS dia_util
FROM orders
""")
def next_business_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.next_business_day(F.to_date("o_orderdate")).alias("dia_util"))
