"""Portfolio data read out of an order-and-event warehouse.

Two views, decades apart and never mixed in one measure: *flow* reads the event log as stage moves of
tickets (history, no deadlines); *delivery* reads orders as tasks with deadlines and hours (no
history). Customers are projects, market segments portfolios, suppliers people.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.functions.labels import origin, origin_code, stage_category
from worklens.functions.text import empty_labels
from worklens.operators.history import no_history, stage_visits
from worklens.operators.pointintime import history_labels
from worklens.plans.gold import (
    Model,
    calendar_table,
    parameters,
    people_dimension,
    project_dimension,
    star,
    task_facts,
)
from worklens.session import scratch_folder
from worklens.sources.calendar import stage_catalog

# fixed values: reference dates (not before the last event and the last order) and mappings of the
# source tables
FLOW_REF = date(2024, 1, 31)
DELIVERY_REF = date(2001, 8, 31)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_STAGE = {
    "signup": "Backlog", "click": "Fazendo", "error": "Impedido", "purchase": "Concluído",
}
PRIORITY = {
    "1-URGENT": ("Crítica", 30), "2-HIGH": ("Alta", 60), "3-MEDIUM": ("Média", 90),
    "4-NOT SPECIFIED": ("Não informada", None), "5-LOW": ("Baixa", 120),
}


class Sources(dict):
    """Source plans by name, built on first use."""

    def __getitem__(self, name: str) -> DataFrame:
        found = super().__getitem__(name)
        if callable(found):
            found = found()
            self[name] = found
        return found


# fixed values: columns of the source tables
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table under its known schema, so that no file is opened to plan a query.

    Zone-less timestamps are read as UTC instants, which keeps filters on them in the scan.
    """
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


# --- flow: the event log --------------------------------------------------------------------------


def flow_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stage moves: one ticket per user and week, ids that sort as text."""
    kind, key = F.col("event_type"), F.col("event_id")
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    stage = F.when(kind == "view", F.when(key % 2 == 0, "A fazer").otherwise("Em revisão"))
    for source, target in EVENT_STAGE.items():
        stage = stage.when(kind == source, target)
    return table(spark, sf_dir, "events").select(
        F.lpad(key.cast("string"), 19, "0").alias("id"),
        (F.col("user_id") * 100 + week).cast("string").alias("tarefa_id"),
        stage.alias("etapa_nova"),
        F.col("user_id").cast("string").alias("usuario_id"),
        F.col("ts").alias("ocorrido_em"),
    )


def flow_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_visits(flow_moves(spark, sf_dir), FLOW_REF)


def flow_moves_with_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves with the stage they left, as a landed history has it."""
    return flow_visits(spark, sf_dir).select(
        F.col("passagem_id").alias("id"),
        "tarefa_id",
        F.col("status_anterior").alias("etapa_anterior"),
        F.col("status").alias("etapa_nova"),
        F.col("pessoa_id").alias("usuario_id"),
        F.col("entrada_utc").alias("ocorrido_em"),
    )


def flow_tasks(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    """Tickets as silver tasks: the state their last event leaves them in."""
    last = F.struct("ocorrido_em", "id")
    tickets = flow_moves(spark, sf_dir).groupBy("tarefa_id").agg(
        F.max("usuario_id").alias("projeto_id"),
        F.max_by("etapa_nova", last).alias("etapa"),
        F.min("ocorrido_em").alias("criada_em"),
        F.max("ocorrido_em").alias("atualizado_em"),
    )
    labels = F.array().cast("array<string>")
    if with_labels:
        tickets = tickets.join(
            history_labels(flow_moves_with_previous(spark, sf_dir)), "tarefa_id", "left")
        labels = empty_labels("etiquetas")
    return tickets.select(
        F.col("tarefa_id").alias("id"),
        "projeto_id",
        F.concat(F.lit("Ticket "), "tarefa_id").alias("titulo"),
        F.lit("Fluxo").alias("tipo"),
        F.lit("Média").alias("prioridade"),
        (F.col("projeto_id").cast("bigint") % 10).cast("string").alias("responsavel_id"),
        F.lit(None).cast("double").alias("estimativa_horas"),
        F.lit(None).cast("double").alias("horas_apontadas"),
        "etapa",
        stage_category("etapa").alias("situacao"),
        labels.alias("etiquetas"),
        "criada_em",
        F.lit(None).cast("date").alias("limite"),
        F.when(F.col("etapa") == "Concluído", F.col("atualizado_em")).alias("concluida_em"),
        "atualizado_em",
    )


# --- delivery: orders and their lines -------------------------------------------------------------


def delivery_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours and owner per order; logged hours add up as whole hundredths."""
    hundredths = F.rint(F.col("l_quantity") * (1 + F.col("l_tax")) * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("estimativa_horas"),
        (F.sum(hundredths) / F.lit(100.0)).alias("horas_apontadas"),
        F.max("l_suppkey").cast("string").alias("responsavel_id"),
    )


def delivery_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as silver tasks; those without lines keep NULL hours and no owner."""
    key = F.col("o_orderkey")
    ref = F.lit(DELIVERY_REF)
    orders = table(spark, sf_dir, "orders")
    finished = F.date_add(F.to_date("o_orderdate"), (key % 150).cast("int"))
    done = (F.col("o_orderstatus") == "F") & (finished <= ref)
    stage = (
        F.when(done, "Concluído")
        .when((F.col("o_orderstatus") == "O") & (key % 10 == 0), "Arquivada")
        .when(F.col("o_orderstatus") == "P", "Impedido")
        .otherwise("Fazendo")
    )
    priority = F.create_map(*[F.lit(x) for k, v in PRIORITY.items() for x in (k, v[0])])
    days = F.create_map(*[F.lit(x) for k, v in PRIORITY.items() if v[1] for x in (k, v[1])])
    return orders.join(delivery_hours(spark, sf_dir), "o_orderkey", "left").select(
        key.cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("projeto_id"),
        F.concat(F.lit("Entrega "), (key % 7).cast("string")).alias("titulo"),
        _pick(["Funcionalidade", "Correção", "Análise"], key % 3).alias("tipo"),
        priority[F.col("o_orderpriority")].alias("prioridade"),
        "responsavel_id",
        "estimativa_horas",
        "horas_apontadas",
        stage.alias("etapa"),
        stage_category(stage).alias("situacao"),
        F.array().cast("array<string>").alias("etiquetas"),
        F.col("o_orderdate").alias("criada_em"),
        F.date_add(F.to_date("o_orderdate"), days[F.col("o_orderpriority")]).alias("limite"),
        F.when(done, finished.cast("timestamp")).alias("concluida_em"),
        F.when(done, finished.cast("timestamp")).otherwise(F.col("o_orderdate"))
        .alias("atualizado_em"),
    )


# --- shared dimensions ----------------------------------------------------------------------------


def portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return segments.select(
        F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment"))
        .cast("int").alias("id"),
        F.col("c_mktsegment").alias("nome"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("id"),
        F.col("s_name").alias("nome"),
        (F.col("s_nationkey") % 5 + 1).cast("int").alias("portfolio_id"),
        _pick(["Analista", "Gestor"], key % 2).alias("cargo"),
        (F.col("s_acctbal") >= 0).alias("ativo"),
        F.date_add(F.lit(date(1990, 1, 1)), (key % 1000).cast("int")).alias("data_admissao"),
    )


def projects(spark: SparkSession, sf_dir: str, view: str = "delivery") -> DataFrame:
    """Customers as silver projects, dated by their orders or, for flow, by their key."""
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    if view == "delivery":
        spans = (
            table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.to_date(F.min("o_orderdate")).alias("inicio"),
                 F.to_date(F.max("o_orderdate")).alias("fim"))
        )
        rows, base, step = customers.join(spans, "c_custkey", "left"), 1500, 100
    else:
        start = F.date_add(F.lit(date(2023, 6, 1)), (key % 240).cast("int"))
        rows, base, step = customers.withColumns({
            "inicio": start, "fim": F.date_add(start, (key % 200 + 30).cast("int")),
        }), 60, 30
    state = F.when(key % 10 == 0, "Arquivado").when(key % 10 <= 3, "Concluído").otherwise("Ativo")
    stage = (
        F.when(state == "Concluído", "Concluído").when(key % 4 == 0, "Planejamento")
        .when(key % 4 == 1, "Implantação").otherwise("Execução")
    )
    on_hold = F.when(key % 6 == 5, F.array(F.lit("Em espera")))
    limit = F.date_add("inicio", (base + key % 11 * step).cast("int"))
    return rows.select(
        key.cast("string").alias("id"),
        F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment"))
        .cast("int").alias("portfolio_id"),
        F.col("c_name").alias("nome"),
        stage.alias("etapa"),
        state.alias("situacao"),
        empty_labels(on_hold).alias("etiquetas"),
        _pick(["Verde", "Amarelo", "Vermelho", "Encerrado"], key % 4).alias("farol"),
        origin("c_name").alias("origem"),
        origin_code("c_name").alias("origem_id"),
        F.col("c_nationkey").cast("string").alias("gerente_id"),
        _pick(["Baixa", "Média", "Alta", "Crítica"], key % 4).alias("prioridade"),
        "inicio",
        F.when(key % 13 != 0, limit).alias("limite"),
        F.when(state == "Concluído", F.col("fim")).alias("concluido_em"),
        (100 + key % 50 * 10).cast("int").alias("horas_orcadas"),
        F.col("c_acctbal").alias("orcamento"),
        F.col("inicio").cast("timestamp").alias("criado_em"),
        F.col("fim").cast("timestamp").alias("atualizado_em"),
    )


# --- models ---------------------------------------------------------------------------------------


def flow_model(spark: SparkSession, sf_dir: str, kept: Collection[str] = ()) -> Model:
    """The event view, with visits; source plans are built when a table needs them.

    Tables named in ``kept`` (``passagens`` are the visits before they meet their tasks) are written
    when first asked for and read back, as a refresh does with all of them. Where several measures
    share a table, histories are then ordered and folded once, and each use reads only its columns.
    """
    folder = scratch_folder(spark) if kept else ""

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name not in kept:
            return df
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return star(spark, Sources({
        "portfolios": lambda: portfolios(spark, sf_dir),
        "usuarios": lambda: people(spark, sf_dir),
        "projetos": lambda: projects(spark, sf_dir, "flow"),
        "tarefas": lambda: flow_tasks(spark, sf_dir),
        "movimentacoes": lambda: flow_moves(spark, sf_dir),
    }), FLOW_REF, stage=stage)


def delivery_model(spark: SparkSession, sf_dir: str) -> Model:
    """Everything but visits: orders carry no history."""
    model = Model({
        "fato_tarefa": lambda: task_facts(
            delivery_tasks(spark, sf_dir), no_history(spark), DELIVERY_REF, "UTC"),
        "dim_projeto": lambda: project_dimension(
            projects(spark, sf_dir), portfolios(spark, sf_dir), people(spark, sf_dir),
            DELIVERY_REF),
        "dim_pessoa": lambda: people_dimension(people(spark, sf_dir), portfolios(spark, sf_dir)),
        "dim_status": lambda: stage_catalog(spark),
        "dim_data": lambda: calendar_table(
            model["fato_tarefa"], model["dim_projeto"], DELIVERY_REF),
        "ref_parametros": lambda: parameters(spark, DELIVERY_REF),
    })
    return model
