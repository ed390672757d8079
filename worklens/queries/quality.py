"""Quarantine, rejects, table comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklens.operators import quarantine as Q
from worklens.operators.compare import (
    diff_summary,
    fingerprint,
    table_diff,
    table_diff_by_digest,
)
from worklens.queries.registry import query
from worklens.sources import warehouse as W
from worklens.sources.warehouse import table


def _projects_with_rules(spark, sf_dir):
    rules = [*Q.row_rules("projetos"), (F.col("orcamento") < 0, "orçamento negativo")]
    return Q.flag_rules(W.projects(spark, sf_dir), rules)


@query("quarantine_rules", """
SELECT projeto_id AS id, CASE WHEN data_limite < data_inicio THEN 'limite antes do início'
       WHEN orcamento < 0 THEN 'orçamento negativo' END AS motivo
FROM projects
""")
def quarantine_rules(spark, sf_dir):
    return _projects_with_rules(spark, sf_dir).select("id", "motivo")


@query("quarantine_builtin_rules", """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'situação de projeto desconhecida'
            WHEN c_acctbal < 0 THEN 'farol desconhecido'
            WHEN c_nationkey > 20 AND primeira < ultima THEN 'limite antes do início' END AS motivo
FROM customer LEFT JOIN (
  SELECT o_custkey AS c_custkey, min(CAST(o_orderdate AS DATE)) AS primeira,
         max(CAST(o_orderdate AS DATE)) AS ultima
  FROM orders GROUP BY 1) USING (c_custkey)
""")
def quarantine_builtin_rules(spark, sf_dir):
    """Every built-in project rule on rows that break it: unknown and missing state, light, dates."""
    spans = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("primeira"),
        F.to_date(F.max("o_orderdate")).alias("ultima"))
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    turned = F.col("c_nationkey") > 20  # written with first and last day swapped
    projects = table(spark, sf_dir, "customer").join(spans, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(segment == "AUTOMOBILE", "Ativo").when(segment == "BUILDING", "Concluído")
        .when(segment == "FURNITURE", "Arquivado").when(segment == "MACHINERY", segment)
        .alias("situacao"),
        F.when(balance >= 5000, "Verde").when(balance >= 0, "Amarelo").otherwise("Preto")
        .alias("farol"),
        F.when(turned, F.col("ultima")).otherwise(F.col("primeira")).alias("inicio"),
        F.when(turned, F.col("primeira")).otherwise(F.col("ultima")).alias("limite"),
    )
    return Q.flag_rules(projects, Q.row_rules("projetos")).select("id", "motivo")


@query("quarantine_orphans", """
SELECT doc_id, CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels)
       THEN 'doc_id sem correspondente' END AS motivo
FROM documents
""")
def quarantine_orphans(spark, sf_dir):
    """Documents without a label; the salted join holds when one key owns most rows."""
    docs = Q.flag_rules(table(spark, sf_dir, "documents").select("doc_id"), [])
    known = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return Q.flag_orphans(docs, "doc_id", known, "doc_id", ["doc_id"])


def _cascade(spark, sf_dir):
    """One portfolio gone and budgets below zero rejected: both reach tasks and their moves."""
    tasks = W.delivery_tasks(spark, sf_dir).select("id", "projeto_id", "responsavel_id", "etapa")
    moves = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderkey").cast("string").alias("tarefa_id"),
        (F.col("o_custkey") % 100).cast("string").alias("usuario_id"),
        F.when(F.col("o_orderstatus") == "P", "Parado").otherwise("Fazendo").alias("etapa_nova"),
    )
    tables = {
        "portfolios": W.portfolios(spark, sf_dir).where("nome <> 'HOUSEHOLD'"),
        "usuarios": W.people(spark, sf_dir).select("id", "portfolio_id"),
        "projetos": W.projects(spark, sf_dir).select(
            "id", "portfolio_id", "gerente_id", "orcamento"),
        "tarefas": tasks,
        "movimentacoes": moves,
    }
    rules = {
        "projetos": [(F.col("orcamento") < 0, "orçamento negativo")],
        "movimentacoes": Q.row_rules("movimentacoes"),
    }
    return Q.cascade(tables, rules=lambda name: rules.get(name, []))


SQL_CASCADE = """
SELECT 'usuarios' AS tabela, id, motivo FROM checked_people WHERE motivo IS NOT NULL
UNION ALL SELECT 'projetos', id, motivo FROM checked_projects WHERE motivo IS NOT NULL
UNION ALL SELECT 'tarefas', id, motivo FROM checked_tasks WHERE motivo IS NOT NULL
UNION ALL SELECT 'movimentacoes', id, motivo FROM checked_moves WHERE motivo IS NOT NULL
"""
SQL_CHECKED = """
, checked_people AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, s_nationkey % 5 + 1 AS portfolio_id,
         CASE WHEN s_nationkey % 5 + 1 = 4 THEN 'portfolio_id sem correspondente' END AS motivo
  FROM supplier
), people_ok AS (SELECT id FROM checked_people WHERE motivo IS NULL
), checked_projects AS (
  SELECT projeto_id AS id, CASE WHEN orcamento < 0 THEN 'orçamento negativo'
         WHEN portfolio = 'HOUSEHOLD' THEN 'portfolio_id sem correspondente'
         WHEN gerente_id NOT IN (SELECT id FROM people_ok) THEN 'gerente_id sem correspondente'
         END AS motivo
  FROM projects
), projects_ok AS (SELECT id FROM checked_projects WHERE motivo IS NULL
), checked_tasks AS (
  SELECT tarefa_id AS id,
         CASE WHEN projeto_id NOT IN (SELECT id FROM projects_ok)
                THEN 'projeto_id sem correspondente'
              WHEN responsavel_id IS NULL OR responsavel_id NOT IN (SELECT id FROM people_ok)
                THEN 'responsavel_id sem correspondente' END AS motivo
  FROM tasks
), tasks_ok AS (SELECT id FROM checked_tasks WHERE motivo IS NULL
), checked_moves AS (
  SELECT 'M' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderstatus = 'P' THEN 'etapa desconhecida'
              WHEN CAST(o_orderkey AS VARCHAR) NOT IN (SELECT id FROM tasks_ok)
                THEN 'tarefa_id sem correspondente'
              WHEN CAST(o_custkey % 100 AS VARCHAR) NOT IN (SELECT id FROM people_ok)
                THEN 'usuario_id sem correspondente' END AS motivo
  FROM orders
)
"""


@query("quarantine_cascade", SQL_CHECKED + SQL_CASCADE)
def quarantine_cascade(spark, sf_dir):
    return Q.all_rejects(_cascade(spark, sf_dir)).drop("registro")


@query("reject_summary", SQL_CHECKED + f"""
SELECT tabela, motivo, count(*) AS linhas FROM ({SQL_CASCADE}) GROUP BY ALL
""")
def reject_summary(spark, sf_dir):
    return Q.reject_summary(Q.all_rejects(_cascade(spark, sf_dir)))


@query("rejects_union", SQL_CHECKED + """
SELECT 'tarefas' AS tabela, c.id, c.motivo,
       '{"id":"' || c.id || '","projeto_id":"' || t.projeto_id || '"'
         || coalesce(',"responsavel_id":"' || t.responsavel_id || '"', '')
         || ',"etapa":"' || t.status || '"}' AS registro
FROM checked_tasks c JOIN tasks t ON t.tarefa_id = c.id WHERE motivo IS NOT NULL
UNION ALL
SELECT 'usuarios', id, motivo,
       '{"id":"' || id || '","portfolio_id":' || CAST(portfolio_id AS VARCHAR) || '}'
FROM checked_people WHERE motivo IS NOT NULL
UNION ALL
SELECT 'projetos', c.id, c.motivo,
       '{"id":"' || c.id || '","portfolio_id":' || CAST(list_position(['AUTOMOBILE', 'BUILDING',
         'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], p.portfolio) AS VARCHAR) || ',"gerente_id":"'
         || p.gerente_id || '","orcamento":' || CAST(p.orcamento AS VARCHAR) || '}'
FROM checked_projects c JOIN projects p ON p.projeto_id = c.id WHERE motivo IS NOT NULL
UNION ALL
SELECT 'movimentacoes', c.id, c.motivo,
       '{"id":"' || c.id || '","tarefa_id":"' || CAST(o_orderkey AS VARCHAR) || '","usuario_id":"'
         || CAST(o_custkey % 100 AS VARCHAR) || '","etapa_nova":"'
         || CASE WHEN o_orderstatus = 'P' THEN 'Parado' ELSE 'Fazendo' END || '"}'
FROM checked_moves c JOIN orders ON 'M' || CAST(o_orderkey AS VARCHAR) = c.id
WHERE motivo IS NOT NULL
""")
def rejects_union(spark, sf_dir):
    """Rejects keep the original record as JSON; NULL fields are left out of it."""
    fields = {
        "usuarios": ["id", "portfolio_id"],
        "projetos": ["id", "portfolio_id", "gerente_id", "orcamento"],
        "tarefas": ["id", "projeto_id", "responsavel_id", "etapa"],
        "movimentacoes": ["id", "tarefa_id", "usuario_id", "etapa_nova"],
    }
    flagged = _cascade(spark, sf_dir)
    return Q.all_rejects({n: flagged[n].select(*c, Q.REASON) for n, c in fields.items()})


MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _exact_lines(spark, sf_dir):
    """Order lines with all columns, two-decimal numbers as whole hundredths."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {c: F.rint(F.col(c) * 100).cast("bigint") for c in MONEY})


SQL_EXACT = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT) AS
       l_quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS l_extendedprice,
       CAST(round(l_discount * 100) AS BIGINT) AS l_discount, CAST(round(l_tax * 100) AS BIGINT) AS
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
"""


def _two_loads(spark, sf_dir):
    """Order lines, and the same after one flag value was reloaded twice and another lost."""
    lines = _exact_lines(spark, sf_dir)
    again = lines.where("l_returnflag = 'R' AND l_linestatus = 'O'")
    changed = lines.where("NOT (l_returnflag = 'A' AND l_linestatus = 'F')").unionByName(again)
    stamp = F.current_timestamp()
    return lines.withColumn("processado_em", stamp), changed.withColumn("processado_em", stamp)


SQL_LOADS = f"""
, linhas AS ({SQL_EXACT})
, recarga AS (
  SELECT * FROM linhas WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'F')
  UNION ALL SELECT * FROM linhas WHERE l_returnflag = 'R' AND l_linestatus = 'O')
"""


@query("table_diff", SQL_LOADS + """
SELECT linhas_b.* EXCLUDE (a, b),
       CAST(sum(a) AS BIGINT) AS copias_a, CAST(sum(b) AS BIGINT) AS copias_b
FROM (SELECT *, 1 AS a, 0 AS b FROM linhas UNION ALL SELECT *, 0, 1 FROM recarga) AS linhas_b
GROUP BY ALL HAVING sum(a) <> sum(b)
""")
def table_diff_query(spark, sf_dir):
    return table_diff(*_two_loads(spark, sf_dir))


@query("table_diff_counts", SQL_LOADS + """
SELECT (SELECT count(*) FROM (FROM linhas EXCEPT ALL FROM recarga)) AS so_em_a,
       (SELECT count(*) FROM (FROM recarga EXCEPT ALL FROM linhas)) AS so_em_b
""")
def table_diff_counts(spark, sf_dir):
    return diff_summary(table_diff(*_two_loads(spark, sf_dir)))


@query("table_diff_by_digest", f"""
, linhas AS ({SQL_EXACT})
, recarga AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 1500 = 7 THEN l_quantity + 100 ELSE l_quantity END
                    AS l_quantity)
  FROM linhas WHERE l_orderkey % 1500 <> 5
  UNION ALL SELECT * FROM linhas WHERE l_orderkey % 1500 = 3)
SELECT linhas_b.* EXCLUDE (a, b),
       CAST(sum(a) AS BIGINT) AS copias_a, CAST(sum(b) AS BIGINT) AS copias_b
FROM (SELECT *, 1 AS a, 0 AS b FROM linhas UNION ALL SELECT *, 0, 1 FROM recarga) AS linhas_b
GROUP BY ALL HAVING sum(a) <> sum(b)
""")
def table_diff_digest(spark, sf_dir):
    """Order lines, and a load of them that lost, repeated and changed a few orders."""
    lines = _exact_lines(spark, sf_dir)
    order = F.col("l_orderkey") % 1500
    changed = lines.where(order != 5).withColumn(
        "l_quantity", F.when(order == 7, F.col("l_quantity") + 100).otherwise(F.col("l_quantity")))
    return table_diff_by_digest(lines, changed.unionByName(lines.where(order == 3)))


@query("fingerprint", f"""
SELECT count(*) AS linhas, CAST(sum(CAST('0x' || substr(sha256(concat_ws(chr(1),
         'v' || CAST(l_orderkey AS VARCHAR), 'v' || CAST(l_partkey AS VARCHAR),
         'v' || CAST(l_suppkey AS VARCHAR), 'v' || CAST(l_linenumber AS VARCHAR),
         'v' || CAST(l_quantity AS VARCHAR), 'v' || CAST(l_extendedprice AS VARCHAR),
         'v' || CAST(l_discount AS VARCHAR), 'v' || CAST(l_tax AS VARCHAR),
         coalesce('v' || nullif(l_returnflag, 'N'), 'n'), 'v' || l_linestatus,
         'v' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))),
         1, 15) AS BIGINT)) AS DECIMAL(38, 0)) AS soma
FROM ({SQL_EXACT})
""")
def fingerprint_query(spark, sf_dir):
    return fingerprint(_exact_lines(spark, sf_dir).withColumn(
        "l_returnflag", F.nullif("l_returnflag", F.lit("N"))))
