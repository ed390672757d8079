"""Landed pages, high-water marks, the run log, calendar and catalog."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from worklens.operators.latest import latest_per_key, latest_snapshot
from worklens.operators.measures import ordered
from worklens.plans.gold import conform
from worklens.queries.registry import query
from worklens.sources import landing
from worklens.sources import warehouse as W
from worklens.sources.calendar import calendar, calendar_bounds, stage_catalog
from worklens.sources.warehouse import DELIVERY_REF, table
from worklens.sources.watermark import (
    changed_since,
    changes,
    run_log,
    watermarks,
    window_start,
)

ISO = "yyyy-MM-dd'T'HH:mm:ss"
PAGE_ROWS = 500  # records per landed page


def _landed_moves(spark, sf_dir):
    """Events as the records an API page would carry: local time with its offset."""
    return W.flow_moves(spark, sf_dir).select(
        "id", "tarefa_id", "etapa_nova", "usuario_id",
        F.concat(F.date_format(F.expr("ocorrido_em - INTERVAL 3 HOURS"), ISO), F.lit("-03:00"))
        .alias("ocorrido_em"),
    )


@query("landing_explode", """
SELECT id, tarefa_id, CAST(NULL AS VARCHAR) AS etapa_anterior, etapa AS etapa_nova, usuario_id,
       strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS ocorrido_em,
       strftime(ts - INTERVAL 3 HOUR, '%Y%m%d') AS _execucao
FROM moves
""")
def landing_explode(spark, sf_dir):
    """JSON pages of at most 500 records, read with the fixed schema and exploded."""
    run = F.regexp_replace(F.substring("ocorrido_em", 1, 10), "-", "")
    record = F.struct("id", "tarefa_id", "etapa_nova", "usuario_id", "ocorrido_em",
                      F.lit("x").alias("campo_extra"))
    # row numbers are unique, so no page outgrows its size whatever the ids hold
    page = F.floor(F.monotonically_increasing_id() / PAGE_ROWS)
    pages = (
        _landed_moves(spark, sf_dir)
        .select(record.alias("r"), run.alias("_execucao"), page.alias("pagina"))
        .groupBy("_execucao", "pagina")
        .agg(F.collect_list("r").alias("dados"))
        .select(F.to_json(F.struct("dados", "_execucao", "pagina")).alias("pagina"))
    )
    return landing.records(landing.parse_pages(pages, "pagina", "movimentacoes"))


@query("latest_meta", """
SELECT CAST(max(ts) AS DATE) AS data_referencia,
       '1.' || CAST(day(max(ts)) AS VARCHAR) AS versao, CAST(day(max(ts)) AS BIGINT) AS semente
FROM events
""")
def latest_meta(spark, sf_dir):
    """Meta pages, one per load day; the newest path gives the reference date."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("dia")).distinct()
    label = F.date_format("dia", "yyyy-MM-dd")
    pages = days.select(
        F.concat(F.lit("meta/data_carga="), label, F.lit("/run.json")).alias("_arquivo"),
        label.alias("data_referencia"),
        F.concat(F.lit("1."), F.dayofmonth("dia").cast("string")).alias("versao"),
        F.dayofmonth("dia").cast("bigint").alias("semente"),
    )
    return landing.latest_meta(pages).drop("processado_em")


def _resources(spark, sf_dir):
    stamp = F.concat(F.date_format("atualizado_em", ISO), F.lit("+00:00"))
    return {
        "movimentacoes": _landed_moves(spark, sf_dir),
        "tarefas": W.delivery_tasks(spark, sf_dir).select(stamp.alias("atualizado_em")),
        "projetos": W.projects(spark, sf_dir).select(stamp.alias("atualizado_em")),
    }


@query("watermark_state", """
SELECT recurso, marca, marca - INTERVAL 5 MINUTE AS desde FROM (
  SELECT 'movimentacoes' AS recurso, max(date_trunc('second', ts)) AS marca FROM moves
  UNION ALL
  SELECT 'tarefas', CAST(max(coalesce(data_conclusao, data_criacao)) AS TIMESTAMP) FROM tasks
  UNION ALL
  SELECT 'projetos', CAST(max(fim) AS TIMESTAMP) FROM spans)
""")
def watermark_state(spark, sf_dir):
    return window_start(watermarks(changes(_resources(spark, sf_dir))))


@query("incremental_window", """
SELECT id, ts AS ocorrido_em FROM moves
WHERE ts > (SELECT max(ts) - INTERVAL 5 MINUTE FROM moves WHERE ts < TIMESTAMP '2024-01-15')
""")
def incremental_window(spark, sf_dir):
    """What the load after January 14th asks for, given the mark that load left."""
    moves = W.flow_moves(spark, sf_dir).select("id", "ocorrido_em")
    earlier = moves.where(F.col("ocorrido_em") < F.lit("2024-01-15").cast("timestamp"))
    marks = watermarks(earlier.select(
        F.lit("movimentacoes").alias("recurso"), F.col("ocorrido_em").alias("alterado_em")))
    return changed_since(moves, "movimentacoes", "ocorrido_em", marks)


@query("run_log", """
SELECT recurso, execucao AS _execucao, paginas, registros,
       CASE WHEN desde IS NULL THEN 'completo' ELSE 'incremental' END AS modo, desde
FROM (
  SELECT event_type AS recurso, strftime(ts, '%Y%m%d') AS execucao,
         count(DISTINCT event_id // 100) AS paginas, count(*) AS registros,
         lag(max(ts)) OVER (PARTITION BY event_type ORDER BY strftime(ts, '%Y%m%d'))
           - INTERVAL 5 MINUTE AS desde
  FROM events GROUP BY 1, 2)
""")
def run_log_query(spark, sf_dir):
    """A resource per event type, a run per day; each run starts from the marks before it."""
    run = F.date_format("ts", "yyyyMMdd")
    pages = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("recurso"), run.alias("_execucao"),
        F.floor(F.col("event_id") / 100).alias("_arquivo"),
    ).agg(F.count(F.lit(1)).alias("registros"), F.max("ts").alias("_last"))
    runs = pages.groupBy("recurso", "_execucao").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("recurso").orderBy("_execucao")  # one row per run
    marks = runs.select(
        "recurso", "_execucao", F.lag("_last").over(before).alias("marca"))
    return run_log(pages, marks)


@query("file_lineage", """
SELECT 'events.parquet' AS arquivo, count(*) AS registros, min(event_id) AS primeiro,
       max(event_id) AS ultimo
FROM events
""")
def file_lineage(spark, sf_dir):
    """Records by the file they were read from; the name comes from the scan itself."""
    return table(spark, sf_dir, "events").groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), r"(events\.parquet)", 1).alias("arquivo")
    ).agg(F.count(F.lit(1)).alias("registros"), F.min("event_id").alias("primeiro"),
          F.max("event_id").alias("ultimo"))


@query("lineage_check", """
, lidos AS (
  SELECT 'events.parquet' AS arquivo, count(*) AS n FROM events
  UNION ALL SELECT 'orders.parquet', count(*) FROM orders
  UNION ALL SELECT 'labels.parquet', count(*) FROM labels
), log AS (
  SELECT 'events.parquet' AS arquivo, count(*) AS n FROM events
  UNION ALL SELECT 'orders.parquet', count(DISTINCT l_orderkey) FROM lineitem
  UNION ALL SELECT 'customer.parquet', count(*) FROM customer
)
SELECT coalesce(lidos.arquivo, log.arquivo) AS arquivo, CAST(lidos.n AS BIGINT) AS registros_lidos,
       CAST(log.n AS BIGINT) AS registros_log,
       CASE WHEN log.n IS NULL THEN 'sem registro no log' WHEN lidos.n IS NULL THEN 'sem arquivo'
            WHEN log.n = lidos.n THEN 'confere' ELSE 'registros diferem' END AS situacao
FROM lidos FULL JOIN log ON lidos.arquivo = log.arquivo
""")
def lineage_check_query(spark, sf_dir):
    """Three files as read, against a log by day, one by order lines, and one of a file not read."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)", 1)
    parts = [
        landing.file_counts(table(spark, sf_dir, t).select(name.alias("_arquivo")))
        for t in ("events", "orders", "labels")
    ]
    by_day = table(spark, sf_dir, "events").groupBy(F.to_date("ts")).agg(
        F.count(F.lit(1)).alias("registros"))
    ordered_lines = table(spark, sf_dir, "lineitem").agg(
        F.count_distinct("l_orderkey").alias("registros"))
    unread = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("registros"))
    log = [
        rows.select(F.lit(f"{t}.parquet").alias("_arquivo"), "registros")
        for t, rows in (("events", by_day), ("orders", ordered_lines), ("customer", unread))
    ]
    read = parts[0].unionByName(parts[1]).unionByName(parts[2])
    logged = log[0].unionByName(log[1]).unionByName(log[2])
    return landing.lineage_check(read, logged).withColumnRenamed("_arquivo", "arquivo")


@query("latest_snapshot", """
SELECT event_id, strftime(ts, '%Y%m%d') AS _execucao FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)
""")
def latest_snapshot_query(spark, sf_dir):
    return latest_snapshot(table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("_execucao")))


@query("latest_per_key", """
SELECT * EXCLUDE (n)
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS n
      FROM lineitem) WHERE n = 1
""")
def latest_per_key_query(spark, sf_dir):
    """Versions of order lines: newest shipping date, then every other column settles a tie."""
    lines = table(spark, sf_dir, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])


@query("status_catalog", """
SELECT s.status, s.categoria, s.ordem, count(v.id) AS passagens
FROM (VALUES ('Backlog', 'Não iniciada', 1), ('A fazer', 'Não iniciada', 2),
             ('Fazendo', 'Em andamento', 3), ('Impedido', 'Em andamento', 4),
             ('Em revisão', 'Em andamento', 5), ('Concluído', 'Concluída', 6),
             ('Arquivada', 'Arquivada', 7)) AS s(status, categoria, ordem)
LEFT JOIN moves v ON v.etapa = s.status GROUP BY ALL
""")
def status_catalog(spark, sf_dir):
    """The stage catalog with how often each stage was entered."""
    entered = W.flow_moves(spark, sf_dir).groupBy(F.col("etapa_nova").alias("status")).agg(
        F.count(F.lit(1)).alias("passagens"))
    return stage_catalog(spark).join(entered, "status", "left").select(
        "status", "categoria", "ordem", F.coalesce("passagens", F.lit(0)).alias("passagens"))


def _bounds(spark, sf_dir):
    created = W.delivery_tasks(spark, sf_dir).select(
        F.to_date("criada_em").alias("data_criacao"))
    spans = W.projects(spark, sf_dir).select(
        F.col("inicio").alias("data_inicio"), F.col("limite").alias("data_limite"))
    return calendar_bounds(created, spans, DELIVERY_REF)


SQL_BOUNDS = """
SELECT least((SELECT min(data_criacao) FROM tasks), (SELECT min(data_inicio) FROM projects),
             DATE '2001-08-31') AS primeiro_dia,
       greatest((SELECT max(data_limite) FROM projects), DATE '2001-08-31') AS ultimo_dia
"""


@query("calendar_bounds", SQL_BOUNDS)
def calendar_bounds_query(spark, sf_dir):
    return _bounds(spark, sf_dir)


SQL_CALENDAR = f"""
SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
       mes_nome, mes_nome || '/' || strftime(data, '%y') AS mes_ano,
       CAST(year(data) * 100 + month(data) AS INTEGER) AS ano_mes,
       'T' || CAST(quarter(data) AS VARCHAR) AS trimestre,
       CAST(data - CAST(isodow(data) - 1 AS INTEGER) AS DATE) AS semana_inicio,
       CAST(isodow(data) AS INTEGER) AS dia_semana,
       list_extract(['seg', 'ter', 'qua', 'qui', 'sex', 'sáb', 'dom'],
                    CAST(isodow(data) AS INTEGER)) AS dia_semana_nome,
       isodow(data) <= 5 AS dia_util, data <= DATE '2001-08-31' AS ate_referencia
FROM (SELECT CAST(d AS DATE) AS data,
             list_extract(['jan', 'fev', 'mar', 'abr', 'mai', 'jun', 'jul', 'ago', 'set', 'out',
                           'nov', 'dez'], CAST(month(d) AS INTEGER)) AS mes_nome
      FROM (SELECT unnest(generate_series(
              CAST(date_trunc('year', primeiro_dia) AS TIMESTAMP),
              CAST(date_trunc('year', ultimo_dia) + INTERVAL 1 YEAR - INTERVAL 1 DAY
                   AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM ({SQL_BOUNDS})))
"""


@query("calendar", SQL_CALENDAR)
def calendar_query(spark, sf_dir):
    return conform(calendar(_bounds(spark, sf_dir), DELIVERY_REF), "dim_data")


@query("sorted_axis", """
SELECT mes_ano, ano_mes, count(*) AS tarefas FROM (
  SELECT list_extract(['jan', 'fev', 'mar', 'abr', 'mai', 'jun', 'jul', 'ago', 'set', 'out',
                       'nov', 'dez'], CAST(month(data_criacao) AS INTEGER))
           || '/' || strftime(data_criacao, '%y') AS mes_ano,
         CAST(year(data_criacao) * 100 + month(data_criacao) AS INTEGER) AS ano_mes
  FROM tasks) GROUP BY ALL ORDER BY ano_mes
""")
def sorted_axis(spark, sf_dir):
    """Month labels in calendar order, not alphabetical."""
    days = calendar(_bounds(spark, sf_dir), DELIVERY_REF).select("data", "mes_ano", "ano_mes")
    created = W.delivery_tasks(spark, sf_dir).groupBy(F.to_date("criada_em").alias("data")).agg(
        F.count(F.lit(1)).alias("_rows"))
    months = created.join(F.broadcast(days), "data").groupBy("mes_ano", "ano_mes").agg(
        F.sum("_rows").alias("tarefas"))
    return ordered(months, "dim_data.mes_ano")
