"""Consistency checks of the star schema.

Checks of single rows can be counted by the write of the fact itself (:data:`ROW_CHECKS`). Those that
need other rows or tables share one pass: every fact row gives a few (kind, key) marks, the keys of
the dimensions give theirs, and two small aggregations compare them. Nothing is joined, so a key with
most of the rows is one row per map task from the start.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.plans.gold import Model

NEGATIVE = "tempos não negativos"
DISORDERED = "ciclo ≤ lead time"

#: What a row of ``fato_tarefa`` must not be.
ROW_CHECKS = {
    NEGATIVE: "ciclo_dias < 0 OR lead_time_dias < 0 OR dias_bloqueada < 0",
    DISORDERED: "ciclo_dias > lead_time_dias",
}

#: Check -> kind of key whose rows need a dimension row of the same key.
PARENTS = {
    "toda tarefa tem projeto": "projeto",
    "todo responsável existe": "pessoa",
    "calendário cobre todas as datas": "criacao",
}
COVERAGE = {
    "calendário cobre as conclusões": "conclusao",
    "calendário cobre as entradas": "entrada",
}
LAST_VISIT = "status da tarefa = última passagem"
ONE_CURRENT = "uma etapa atual por tarefa"

CHECKS = ["toda tarefa tem projeto", "todo responsável existe", LAST_VISIT, ONE_CURRENT, NEGATIVE,
          DISORDERED, "calendário cobre todas as datas"]

#: What a mark counts, next to its kind, key and stage.
COUNTED = ("tarefas", "atuais", "linhas", *ROW_CHECKS)


def _mark(kind: str, key: str | Column, stage: Column | None = None, **counts: Column) -> Column:
    """One entry of the pass; what is not counted is zero."""
    key = F.col(key) if isinstance(key, str) else key
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.lit(kind).alias("tipo"), key.cast("string").alias("chave"),
        (F.lit(None) if stage is None else stage).cast("string").alias("etapa"),
        *[counts.get(name, zero).cast("bigint").alias(name) for name in COUNTED],
        F.lit(False).alias("conhecida"))


def _marks(rows: DataFrame, marks: list[Column]) -> DataFrame:
    return rows.select(F.inline(F.array(*marks)))


def _known(rows: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """Keys of a dimension; a NULL key is nobody's parent."""
    found = _marks(rows.where(F.col(key).isNotNull()), [_mark(kind, key) for kind in kinds])
    return found.withColumn("conhecida", F.lit(True))


def _task_marks(tasks: DataFrame, kinds: Collection[str], row_checks: Collection[str]) -> DataFrame:
    one = F.lit(1)
    broken = {
        name: F.when(F.expr(rule), 1).otherwise(0)
        for name, rule in ROW_CHECKS.items() if name in row_checks
    }
    keys = {"projeto": "projeto_id", "pessoa": "responsavel_id", "criacao": "data_criacao"}
    marks = [_mark("tarefa", "tarefa_id", F.col("status"), tarefas=one, **broken)]
    marks += [_mark(kind, key, linhas=one) for kind, key in keys.items()]
    if "conclusao" in kinds:  # open tasks have no such day
        done = F.when(F.col("data_conclusao").isNotNull(), 1).otherwise(0)
        marks.append(_mark("conclusao", "data_conclusao", linhas=done))
    return _marks(tasks, marks)


def _visit_marks(visits: DataFrame, kinds: Collection[str]) -> DataFrame:
    if "entrada" not in kinds:
        visits = visits.where("etapa_atual")
    current = F.when(F.col("etapa_atual"), 1).otherwise(0)
    marks = [_mark("tarefa", "tarefa_id", F.col("status"), atuais=current)]
    if "entrada" in kinds:
        marks.append(_mark("entrada", "data_entrada", linhas=F.lit(1)))
    return _marks(visits, marks)


def _violations(model: Model, checks: list[str]) -> DataFrame:
    """``checagem, violacoes`` of the checks named, from one reading of each table."""
    parents = {n: kind for n, kind in (PARENTS | COVERAGE).items() if n in checks}
    kinds = set(parents.values())
    days = [kind for kind in ("criacao", "conclusao", "entrada") if kind in kinds]
    marks = _task_marks(model["fato_tarefa"], kinds, checks)
    for part in (
        _visit_marks(model["fato_passagem_status"], kinds),
        _known(model["dim_projeto"], "projeto_id", ["projeto"]),
        _known(model["dim_pessoa"], "pessoa_id", ["pessoa"]),
        _known(model["dim_data"], "data", days),
    ):
        marks = marks.unionByName(part)

    # first by stage as well: a task with many current visits is a row a stage, not a row a visit
    staged = marks.groupBy("tipo", "chave", "etapa").agg(
        *[F.sum(name).alias(name) for name in COUNTED], F.max("conhecida").alias("conhecida"))
    paired = F.col("etapa").isNotNull() & F.col("chave").isNotNull()

    def of_pairs(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(paired, value)), F.lit(0))

    tasks, current = F.col("tarefas"), F.col("atuais")
    keyed = staged.groupBy("tipo", "chave").agg(
        *[F.sum(name).alias(name) for name in COUNTED], F.max("conhecida").alias("conhecida"),
        # pairs of a task and a current visit of it, less the pairs of one stage
        (of_pairs(tasks) * of_pairs(current) - of_pairs(tasks * current)).alias("divergentes"))

    def total(value: Column | str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    found = {name: total(name) for name in ROW_CHECKS}
    found[LAST_VISIT] = total("divergentes")
    found[ONE_CURRENT] = F.count_if(F.col("atuais") > 1)
    for name, kind in parents.items():
        found[name] = total(F.when((F.col("tipo") == kind) & ~F.col("conhecida"), F.col("linhas")))
    totals = keyed.agg(*[found[name].alias(name) for name in checks])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("checagem"), F.col(f"`{name}`").alias("violacoes"))
        for name in checks
    ])))


def gold_checks(model: Model) -> DataFrame:
    """``checagem, violacoes``: every check that must be zero before the model is used."""
    return _violations(model, CHECKS)


def calendar_coverage(model: Model) -> DataFrame:
    """The same for the dates the other two roles of the calendar use."""
    return _violations(model, list(COVERAGE))


def row_metrics() -> dict[str, Column]:
    """Counts of rows that break a rule on their own, for the write of ``fato_tarefa`` to observe."""
    return {name: F.count_if(F.expr(rule)) for name, rule in ROW_CHECKS.items()}


def require_consistent(model: Model, observed: Collection[str] = ()) -> None:
    """Raise when any check fails. The result collected is one row per check.

    ``observed`` names checks that the write has already held; their columns are not read again.
    """
    checks = [name for name in (*CHECKS, *COVERAGE) if name not in observed]
    failed = [
        row["checagem"] for row in _violations(model, checks).where("violacoes > 0").collect()]
    if failed:
        raise AssertionError(f"inconsistent model: {failed}")
