"""Audits, point-in-time state, schedule months and table comparison."""

from datetime import date

import pytest
from landed_pages import move
from pyspark.sql import functions as F

from worklens.functions.times import instant
from worklens.operators import audit as A
from worklens.operators import pointintime as P
from worklens.operators.compare import (
    diff_summary,
    fingerprint,
    table_diff,
    table_diff_by_digest,
)
from worklens.operators.spans import project_months, task_months

REF = date(2026, 9, 30)
EVENTS = [
    move("E01", "T1", None, "Backlog", "2026-08-01T09:00:00-03:00"),
    move("E02", "T1", "Backlog", "Fazendo", "2026-08-02T09:00:00-03:00"),
    move("E03", "T1", "Fazendo", "Em revisão", "2026-08-03T09:00:00-03:00"),
    move("E04", "T1", "Em revisão", "Fazendo", "2026-08-04T09:00:00-03:00"),
    move("E05", "T2", "Backlog", "Fazendo", "2026-08-04T09:00:00-03:00"),
    move("E06", "T2", "Backlog", "Impedido", "2026-08-03T09:00:00-03:00"),
    move("E07", "T3", None, "Backlog", "2026-08-20T09:00:00-03:00"),
]


@pytest.fixture(scope="module")
def moves(spark):
    return spark.createDataFrame(
        [tuple(e.values()) for e in EVENTS],
        "id string, tarefa_id string, etapa_anterior string, etapa_nova string, "
        "usuario_id string, ocorrido_em string").withColumn("ocorrido_em", instant("ocorrido_em"))


def found(df):
    return sorted((r["id"], r["problema"]) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [1, None])
def test_steps(moves, hot_rows):
    assert found(A.history_steps(moves, hot_rows)) == [
        ("E05", "histórico não começa na criação"),
        ("E06", "histórico fora de ordem"), ("E06", "histórico pula etapa")]


def test_tasks_against_history(spark, moves):
    tasks = spark.createDataFrame([
        ("T1", "Fazendo", "2026-08-01 12:00:00", "2026-08-04 12:00:00"),
        ("T2", "Fazendo", "2026-08-04 12:00:00", "2026-08-03 12:00:00"),
        ("T3", "Backlog", "2026-08-20 12:00:00", "2026-08-21 12:00:00"),
        ("T4", "Backlog", "2026-08-20 12:00:00", "2026-08-21 12:00:00"),
    ], "id string, etapa string, c string, a string").select(
        "id", "etapa", F.col("c").cast("timestamp").alias("criada_em"),
        F.col("a").cast("timestamp").alias("atualizado_em"))
    assert found(A.history_matches_tasks(tasks, moves)) == [
        ("T2", "status atual difere do último evento"),
        ("T3", "datas da tarefa não batem com o histórico"), ("T4", "sem histórico")]


def test_coherence(spark):
    tasks = spark.createDataFrame([
        ("a", "Concluído", None, "2026-09-01 12:00:00", 1.0),
        ("b", "Em Pausa", None, "2026-10-01 02:00:00", -1.0),
        ("c", "Fazendo", None, "2026-10-01 12:00:00", 1.0),
    ], "id string, etapa string, d string, u string, horas_apontadas double").select(
        "id", "etapa", F.col("d").cast("timestamp").alias("concluida_em"),
        F.col("u").cast("timestamp").alias("atualizado_em"), "horas_apontadas")
    assert found(A.task_coherence(tasks, REF)) == [
        ("a", "data de conclusão incoerente com o status"), ("b", "horas negativas"),
        ("b", "status desconhecido"), ("c", "data depois da referência")]
    projects = spark.createDataFrame([
        ("p", "Ativo", "Verde", date(2026, 1, 1), date(2026, 1, 1), None),
        ("q", "Concluído", "Roxo", date(2026, 1, 1), date(2026, 2, 1), None),
    ], "id string, situacao string, farol string, inicio date, limite date, concluido_em date")
    assert found(A.project_coherence(projects)) == [
        ("p", "fim planejado antes do início"),
        ("q", "data de conclusão incoerente com o status"),
        ("q", "situação ou farol desconhecido")]


def test_duplicates(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "id string")
    assert found(A.duplicates(df, "t")) == [("x", "id duplicado")]


def test_state_as_of_and_stability(moves):
    cut = F.lit("2026-08-03 12:00:00").cast("timestamp")
    state = {r["tarefa_id"]: r["status"] for r in P.state_as_of(moves, cut).collect()}
    assert state == {"T1": "Em revisão", "T2": "Impedido"}  # T3 does not exist yet
    later = P.state_as_of(moves, F.lit("2026-08-30").cast("timestamp"))
    assert P.cut_differences(P.state_as_of(moves, cut), later, cut).count() == 0
    lossy = P.state_as_of(moves.where("tarefa_id <> 'T2'"), cut)
    assert P.cut_differences(P.state_as_of(moves, cut), lossy, cut).first()[1] == "tarefa sumiu"


def test_labels(moves):
    labels = {r["tarefa_id"]: r["etiquetas"] for r in P.history_labels(
        moves.where("id <> 'E05'")).collect()}
    assert labels == {"T1": ["Retrabalho"], "T2": ["Bloqueada"], "T3": []}


def test_project_stage(spark):
    tasks = spark.createDataFrame([
        ("A", "Backlog"), ("A", "A fazer"), ("B", "Concluído"), ("B", "Arquivada"),
        *[("C", "Concluído")] * 4, ("C", "Fazendo"), ("D", "Concluído"), ("D", "Fazendo"),
        ("F", "Concluído"),
    ], "projeto_id string, etapa string").withColumn("atualizado_em", F.lit(0))
    projects = spark.createDataFrame(
        [(p, p == "E", p == "F") for p in "ABCDEF"], "projeto_id string, none boolean, off boolean")
    state, stage = P.project_stage(
        F.col("off"), F.lit(True), F.lit(date(2026, 1, 1)), F.lit(REF))
    got = {r[0]: (r[1], r[2]) for r in projects.join(
        P.task_progress(tasks), "projeto_id", "left").select("projeto_id", state, stage).collect()}
    assert got == {
        "A": ("Ativo", "Planejamento"), "B": ("Concluído", "Concluído"),
        "C": ("Ativo", "Implantação"), "D": ("Ativo", "Execução"),
        "E": ("Ativo", "Planejamento"), "F": ("Arquivado", "Execução")}


def test_budget(spark):
    tasks = spark.createDataFrame([
        ("A", date(2026, 1, 1), 40.0), ("A", date(2026, 2, 1), 41.0), ("A", date(2026, 5, 1), 99.0),
    ], "projeto_id string, criada_em date, estimativa_horas double")
    scope = spark.createDataFrame(
        [("A", 1, date(2026, 2, 1)), ("B", 1, date(2026, 2, 1))],
        "projeto_id string, portfolio_id int, escopo_ate date")
    rates = spark.createDataFrame([(1, 160)], "portfolio_id int, custo_hora int")
    got = {r["projeto_id"]: (r["horas_orcadas"], r["orcamento"]) for r in
           P.budget_rollup(tasks, scope, rates).collect()}
    assert got == {"A": (90, 14400.0), "B": (0, 0.0)}


def test_schedule_months_match_a_nested_loop(spark):
    days = [date(2025, 1, 31), date(2025, 2, 1), date(2025, 3, 15), date(2026, 12, 31),
            date(2027, 1, 1), None]
    rows = [(f"p{i}-{j}-{k}", "n", s, "x", a, b, c) for i, a in enumerate(days)
            for j, b in enumerate(days) for k, c in enumerate(days[:3] + [None])
            for s in ("Arquivado", "Em execução")]
    projects = spark.createDataFrame(rows, (
        "projeto_id string, projeto string, status string, situacao_prazo string, "
        "data_inicio date, data_limite date, data_conclusao date"))
    first, last = date(2025, 1, 1), date(2026, 12, 31)
    got = sorted((r["projeto_id"], r["mes_inicio"]) for r in
                 project_months(projects, first, last, REF).collect())
    months = [date(y, m, 1) for y in (2025, 2026) for m in range(1, 13)]
    ends = [date(y + m // 12, m % 12 + 1, 1) for y in (2025, 2026) for m in range(1, 13)]
    expected = []
    for pid, _, status, _, start, limit, done in rows:
        end = done or (limit if status == "Arquivado" else max(limit or REF, REF))
        for low, after in zip(months, ends):
            if start and end and start < after and end >= low:
                expected.append((pid, low))
    assert got == sorted(expected)


def test_equal_titles_share_a_bar(spark):
    tasks = spark.createDataFrame([
        ("P", "t", date(2026, 1, 5), date(2026, 2, 5), "Concluído", "Concluída no prazo"),
        ("P", "t", date(2026, 3, 5), None, "Impedido", "Sem prazo"),
    ], "projeto_id string, titulo string, data_criacao date, data_conclusao date, status string, "
       "situacao_prazo string")
    got = task_months(tasks, date(2026, 1, 1), date(2026, 12, 31), REF).collect()
    assert sorted(r["mes_inicio"].month for r in got) == [1, 2]
    assert {r["cor"] for r in got} == {"#C4851A"}


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (3, None), (3, None)], "a int, b string")
    stamp = F.current_timestamp()
    diff = table_diff(a.withColumn("processado_em", stamp), b.withColumn("processado_em", stamp))
    assert sorted(tuple(r) for r in diff.collect()) == [
        (1, "x", 2, 1), (2, None, 1, 0), (3, None, 0, 2)]
    assert tuple(diff_summary(diff).first()) == (2, 2)
    assert tuple(diff_summary(table_diff(a, a)).first()) == (0, 0)
    with pytest.raises(ValueError, match="columns"):
        table_diff(a, b.select("b", "a"))


def _shuffled_rows(plan) -> int:
    """Rows that the exchanges of an executed plan wrote."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(_shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_digest_tree_shuffles_only_what_differs(spark):
    n = 400_000
    a = spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("b"),
        (F.col("id") / 7).alias("c"))
    b = a.withColumn("c", F.when(F.col("id") == 77_777, -0.5).otherwise(F.col("c")))
    diff = table_diff_by_digest(a, b)
    assert sorted((r["id"], r["c"], r["copias_a"], r["copias_b"]) for r in diff.collect()) == [
        (77_777, -0.5, 0, 1), (77_777, 77_777 / 7, 1, 0)]
    plan = diff._jdf.queryExecution().executedPlan()
    assert 0 < _shuffled_rows(plan) < 0.02 * 2 * n
    plain = table_diff(a, b)
    plain.collect()
    assert _shuffled_rows(plain._jdf.queryExecution().executedPlan()) >= 2 * n


def test_digest_tree_finds_the_rows_of_the_plain_comparison(spark):
    rows = [(1, "x"), (1, "x"), (2, None), (None, "2"), (None, None), (4, ""), (5, "y"), (5, "y")]
    other = [(1, "x"), (3, None), (3, None), (None, "2"), (2, ""), (4, None), (5, "y"), (5, "z")]
    a = spark.createDataFrame(rows, "a int, b string")
    b = spark.createDataFrame(other, "a int, b string")
    for left, right in ((a, b), (b, a), (a, a), (a, b.where("false")), (a.union(a), a)):
        wanted = sorted(map(repr, table_diff(left, right).collect()))
        for fanout, depth in ((256, 2), (2, 3), (1, 1)):
            got = table_diff_by_digest(left, right, fanout=fanout, depth=depth).collect()
            assert sorted(map(repr, got)) == wanted
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "a double")
    assert table_diff_by_digest(zero, spark.createDataFrame([(0.0,), (0.0,)], "a double")).isEmpty()
    with pytest.raises(ValueError, match="columns"):
        table_diff_by_digest(a, b.select("b", "a"))
    with pytest.raises(ValueError, match="leaves"):
        table_diff_by_digest(a, b, depth=3)


def test_fingerprint_ignores_order_and_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, "")], "a int, b string")
    same = a.orderBy(F.desc("a"))
    assert fingerprint(a).first() == fingerprint(same).first()
    for other in (a.union(a.limit(1)), a.where("a = 1"), a.fillna("", ["b"])):
        assert fingerprint(other).first() != fingerprint(a).first()
    pair = spark.createDataFrame([(9, "z"), (9, "z")], "a int, b string")
    assert fingerprint(a.union(pair)).first() != fingerprint(a).first()
