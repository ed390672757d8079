"""Measures in context, on a small model checked by hand and by brute force."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from worklens.operators.access import secured
from worklens.operators.compare import reconcile
from worklens.plans import crosscheck, reports
from worklens.plans.gold import Model, conform
from worklens.plans.measures import BY_NAME, CATALOG, PERIOD, SCHEDULE, as_role, long_form, measure
from worklens.schemas import STAGES, gold_schema
from worklens.sources.calendar import calendar, stage_catalog

REF = date(2026, 9, 30)

PROJECTS = [  # id, portfolio, status, deadline state, light, origin, hours, budget, late
    ("P1", "A", "Em execução", "Atrasado", "Vermelho", "Ideia", 100, 1_000_000.0, 10),
    ("P2", "A", "Planejamento", "No prazo", "Verde", "Direto", 50, 500_000.0, 0),
    ("P3", "B", "Concluído", "Concluído no prazo", "Encerrado", "Ideia", 20, 250_000.0, 0),
    ("P4", "B", "Em espera", "Em espera", "Amarelo", "Direto", 0, 0.0, None),
    ("P5", "C", "Arquivado", "Arquivado", "Encerrado", "Direto", 10, 0.0, None),
]
TASKS = [  # id, project, person, status, created, done, deadline state, late, est, logged, cycle
    ("T1", "P1", "U1", "Concluído", date(2026, 8, 1), date(2026, 9, 2), "Concluída no prazo", 0,
     10.0, 12.0, 1.25),
    ("T2", "P1", "U2", "Fazendo", date(2026, 9, 1), None, "Vencida", 20, 5.0, 1.0, None),
    ("T3", "P1", "U1", "Impedido", date(2026, 9, 5), None, "Sem prazo", 0, 2.0, 0.0, None),
    ("T4", "P3", "U2", "Concluído", date(2026, 8, 9), date(2026, 8, 20), "Concluída com atraso", 4,
     10.0, 8.0, 3.75),
    ("T5", "P3", "U1", "Arquivada", date(2026, 9, 9), None, "Arquivada", None, 1.0, 0.0, None),
    ("T6", "P9", "U9", "Fazendo", date(2026, 9, 9), None, "No prazo", 0, 1.0, 0.0, None),  # orphan
]
VISITS = [  # id, task, status, entry, days, current, final
    ("V1", "T1", "Backlog", date(2026, 8, 1), 2.0, False, False),
    ("V2", "T1", "Impedido", date(2026, 8, 3), 4.5, False, False),
    ("V3", "T1", "Concluído", date(2026, 9, 2), None, True, True),
    ("V4", "T2", "Fazendo", date(2026, 9, 1), 29.0, True, False),
    ("V5", "T3", "Impedido", date(2026, 9, 5), 15.0, True, False),
    ("V6", "T4", "Concluído", date(2026, 8, 20), None, True, True),
    ("V7", "T5", "Arquivada", date(2026, 9, 9), None, True, True),
]


def frame(spark, table, rows, columns):
    """Rows as a gold table; columns the test does not set are NULL."""
    df = spark.createDataFrame(rows, columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in gold_schema(table)
               if f.name not in df.columns}
    return conform(df.withColumns(missing) if missing else df, table)


@pytest.fixture(scope="module")
def model(spark):
    projects = frame(spark, "dim_projeto", PROJECTS, (
        "projeto_id string, portfolio string, status string, situacao_prazo string, farol string, "
        "origem string, horas_orcadas int, orcamento double, dias_atraso int")).withColumn(
        "projeto", F.concat(F.lit("Projeto "), "projeto_id"))
    tasks = frame(spark, "fato_tarefa", [
        (*t[:6], t[6], t[7], t[8], t[9], t[10], t[3] not in ("Concluído", "Arquivada"),
         1 if t[0] == "T1" else 0, date(2026, 9, 10) if t[0] in ("T1", "T2", "T4") else None,
         datetime(2026, 1, 1)) for t in TASKS], (
        "tarefa_id string, projeto_id string, responsavel_id string, status string, "
        "data_criacao date, data_conclusao date, situacao_prazo string, dias_atraso int, "
        "estimativa_horas double, horas_apontadas double, ciclo_dias double, aberta boolean, "
        "qtd_retrabalho bigint, data_limite date, criada_em timestamp"))
    orders = {name: order for name, _, order in STAGES}
    visits = frame(spark, "fato_passagem_status", [
        (*v, orders[v[2]], None if v[5] else datetime(2026, 9, 2)) for v in VISITS], (
        "passagem_id string, tarefa_id string, status string, data_entrada date, "
        "dias_na_etapa double, etapa_atual boolean, etapa_final boolean, ordem_etapa int, "
        "saida_em timestamp"))
    people = frame(spark, "dim_pessoa", [("U1", "Ana", "A"), ("U2", "Bia", "B")],
                   "pessoa_id string, pessoa string, portfolio string")
    bounds = spark.createDataFrame([(date(2026, 8, 1), date(2026, 9, 1))],
                                   "primeiro_dia date, ultimo_dia date")
    tables = {
        "dim_projeto": projects.cache(), "fato_tarefa": tasks.cache(),
        "fato_passagem_status": visits.cache(), "dim_pessoa": people,
        "dim_status": stage_catalog(spark), "dim_data": conform(calendar(bounds, REF), "dim_data"),
        "ref_parametros": frame(spark, "ref_parametros", [(REF,)], "data_referencia date"),
    }
    return Model({n: lambda df=df: df for n, df in tables.items()})


def values(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


def single(model, name, **context):
    return measure(model, [name], **context).first()[0]


def test_the_catalog_is_complete():
    assert len(CATALOG) + len(SCHEDULE) == 54
    assert len({m.name for m in CATALOG}) == 52
    assert set(PERIOD) <= set(BY_NAME)


@pytest.mark.parametrize(("name", "value"), [
    ("Projetos", 5), ("Projetos Ativos", 2), ("Projetos Atrasados", 1),
    ("% Projetos Atrasados", 0.5), ("% Projetos Entregues no Prazo", 1.0),
    ("Atraso Médio dos Projetos (dias)", 10.0), ("Horas Orçadas", 180),
    ("Tarefas", 6), ("Tarefas Abertas", 3), ("Tarefas Vencidas", 1), ("% Abertas Vencidas", 1.0),
    ("% Entregues no Prazo", 0.5), ("Atraso Médio das Tarefas (dias)", 12.0),
    ("Ciclo Médio (dias)", 2.5), ("Ciclo Mediano (dias)", 2.5),
    ("% Concluídas com Retrabalho", 0.5), ("Desvio de Esforço %", 0.0),
    ("Saldo do Período", 4), ("Tempo Médio na Etapa (dias)", 3.25),
    ("Tarefas Paradas na Etapa", 2), ("Paradas há mais de 15 dias", 1),
    ("Mudanças de Status", 7), ("Bloqueios no Período", 2),
    ("Data de Referência", "30/09/2026"), ("Texto Referência", "Dados até 30/09/2026"),
    ("Contexto Projetos Ativos", "de 5 no portfólio"),
    ("Contexto Atrasados de Ativos", "1 de 2 ativos"),
    ("Contexto Projetos Atrasados", "50% dos ativos"),
    ("Contexto Horas Apontadas", "-28% vs. o estimado"), ("Texto Orçamento", "R$ 1,8 mi"),
    ("Contexto Orçamento Consumido", "12% das horas orçadas já usadas"),
])
def test_without_context(model, name, value):
    got = single(model, name)
    assert got == (pytest.approx(value) if isinstance(value, float) else value)


def test_every_measure_evaluates_at_once(model):
    names = [m.name for m in CATALOG]
    row = measure(model, names).first()
    assert len(row) == 52 and row["Tarefas Entregues"] == 2


def test_orphan_facts_show_under_a_blank_portfolio(model):
    got = values(measure(model, ["Tarefas", "Projetos"], ["dim_projeto.portfolio"]))
    assert got == {"A": (3, 2), "B": (2, 2), "C": (None, 1), None: (1, None)}


def test_slicer_reaches_tasks_and_visits(model):
    names = ["Tarefas", "Mudanças de Status", "Tarefas Paradas na Etapa"]
    row = measure(model, names, filters={"dim_projeto.portfolio": ["A"]}).first()
    assert tuple(row) == (3, 5, 2)


def test_fact_filters_do_not_reach_dimensions(model):
    assert single(model, "Projetos", filters={"fato_tarefa.status": ["Fazendo"]}) == 5


def test_condition_replaces_the_slicer_on_its_column(model):
    slicer = {"dim_projeto.status": ["Em espera"]}
    row = measure(model, ["Projetos", "Projetos Ativos", "Projetos Atrasados"],
                  filters=slicer).first()
    assert tuple(row) == (1, 2, None)


def test_condition_replaces_the_axis_on_its_column(model):
    got = values(measure(model, ["Projetos", "Projetos Ativos"], ["dim_projeto.status"]))
    assert got == {s: (1, 2) for s in
                   ("Em execução", "Planejamento", "Concluído", "Em espera", "Arquivado")}


def test_table_filter_narrows_instead(model):
    got = values(measure(model, ["Desvio de Esforço %"], ["fato_tarefa.status"]))
    assert got["Concluído"][0] == pytest.approx(0.0)
    assert got["Fazendo"] == (-1.0,)  # nothing done here: BLANK - 1


def test_role_wins_over_every_condition(model):
    row = measure(model, ["Projetos", "Projetos Ativos", "Tarefas", "Mudanças de Status"],
                  portfolio="B", filters={"dim_projeto.status": ["Em execução"]}).first()
    assert tuple(row) == (None, None, None, None)
    row = measure(model, ["Projetos", "Projetos Ativos", "Projetos Concluídos"],
                  portfolio="A", filters={"dim_projeto.status": ["Concluído"]}).first()
    assert tuple(row) == (None, 2, None)


def test_role_through_a_secured_model_is_the_same(model):
    names = ["Projetos", "Tarefas", "Tarefas Abertas", "Mudanças de Status"]
    for portfolio in "ABC":
        filtered = measure(model, names, portfolio=portfolio).first()
        assert measure(secured(model, portfolio), names).first() == filtered
    assert secured(model, "A")["dim_pessoa"].count() == 2
    assert as_role("DadosAnalytics") == "Dados & Analytics"


def test_date_roles(model):
    got = values(measure(
        model, ["Tarefas Criadas", "Tarefas Entregues", "Saldo do Período", "Mudanças de Status"],
        ["dim_data.mes_ano"]))
    assert got == {"ago/26": (2, 1, 1, 3), "set/26": (4, 1, 3, 4)}
    month = {"dim_data.mes_ano": ["set/26"]}
    assert single(model, "Mudanças de Status", filters=month) == 4
    assert single(model, "Tarefas Entregues", filters=month) == 1


def test_period_without_rows_is_blank(model):
    month = {"dim_data.mes_ano": ["jan/26"]}
    row = measure(model, ["Tarefas Criadas", "Saldo do Período", "Desvio de Esforço %",
                          "Contexto Tarefas Abertas"], filters=month).first()
    assert tuple(row) == (None, None, -1.0, "0 impedidas agora")


def test_visits_follow_the_current_status_of_their_task(model):
    got = values(measure(model, ["Mudanças de Status"], ["dim_status.status"]))
    assert got["Concluído"] == (4,) and got["Fazendo"] == (1,)
    own = values(measure(model, ["Mudanças de Status"], ["fato_passagem_status.status"]))
    assert own["Concluído"] == (2,) and own["Backlog"] == (1,)


def test_people_axis_and_two_axes(model):
    got = values(measure(model, ["Tarefas", "Tarefas Paradas na Etapa"], ["dim_pessoa.pessoa"]))
    assert got == {"Ana": (3, 1), "Bia": (2, 1), None: (1, None)}
    both = measure(model, ["Tarefas"], ["dim_projeto.portfolio", "dim_pessoa.pessoa"]).collect()
    assert {tuple(r) for r in both} == {
        ("A", "Ana", 2), ("A", "Bia", 1), ("B", "Ana", 1), ("B", "Bia", 1), (None, None, 1)}


def test_a_total_repeats_where_the_axis_does_not_reach(model):
    got = measure(model, ["Tarefas", "Projetos"], ["dim_projeto.portfolio", "fato_tarefa.status"])
    assert {(r["portfolio"], r["Projetos"]) for r in got.collect()} == {
        ("A", 2), ("B", 2), (None, None)}
    months = values(measure(model, ["Projetos"], ["dim_data.ano"]))
    assert months == {2026: (5,)}
    with pytest.raises(ValueError, match="axis"):
        measure(model, ["Projetos"], ["dim_data.ano", "dim_pessoa.pessoa"])


def test_median_by_axis_counts_values(model):
    got = values(measure(model, ["Ciclo Mediano (dias)"], ["dim_projeto.portfolio"]))
    assert got == {"A": (1.25,), "B": (3.75,)}


def test_reports(model):
    assert [tuple(r) for r in reports.health(model).collect()][0] == ("Encerrado", 2)
    assert [tuple(r) for r in reports.at_risk(model).collect()] == [("Projeto P1", 10)]
    assert [r["portfolio"] for r in reports.by_portfolio(model).collect()] == ["A"]
    assert [r["status"] for r in reports.stalled(model).collect()] == ["Fazendo", "Impedido"]
    months = [r["mes_ano"] for r in reports.created_delivered(model).collect()]
    assert months == ["ago/26", "set/26"]
    assert reports.overdue(model).count() == 1
    totals = {r["portfolio"]: (r["projetos"], r["tarefas"], r["abertas"])
              for r in reports.portfolio_totals(model).collect()}
    assert totals == {"A": (2, 3, 2), "B": (2, 2, 0), "C": (1, 0, 0)}


def test_reconciliation(spark, model):
    names = crosscheck.FLOW_NAMES[:2]
    ours = long_form(measure(model, names), names)
    agreed = {r["medida"]: r["confere"] for r in reconcile(
        ours, crosscheck.independent_flow(spark, model)).collect()}
    assert agreed["Tempo Médio na Etapa (dias)"] is True
    assert agreed["Dias Bloqueada"] is False  # missing on our side
    off = ours.withColumn("valor", F.col("valor") + 0.007)
    assert not any(r["confere"] for r in reconcile(
        off, crosscheck.independent_flow(spark, model)).where("valor_a is not null").collect())


def test_reconciliation_without_rows(spark, model):
    """Ratios without a divisor are BLANK on both sides, and that agrees."""
    empty = model.replacing({
        name: lambda name=name: model[name].where("false")
        for name in ("dim_projeto", "fato_tarefa", "fato_passagem_status")})
    names = crosscheck.NAMES
    ours = long_form(measure(empty, names), names)
    got = {r["medida"]: r for r in reconcile(ours, crosscheck.independent(spark, empty)).collect()}
    assert got["% Projetos Atrasados"]["confere"] and got["% Projetos Atrasados"]["valor_b"] is None
    assert got["Desvio de Esforço %"]["valor_a"] == -1.0  # BLANK counts as zero in a subtraction
    flow = crosscheck.FLOW_NAMES
    rows = reconcile(long_form(measure(empty, flow), flow), crosscheck.independent_flow(spark, empty))
    assert rows.where("medida LIKE '%Médio%' AND confere").count() == 2


def test_reconciliation_of_blank_numbers(spark):
    schema = "medida string, valor double, texto string"
    a = spark.createDataFrame([("x", None, None), ("y", None, None), ("z", 1.0, None)], schema)
    b = spark.createDataFrame([("x", None, None), ("y", 2.0, None)], schema)
    assert {r["medida"]: r["confere"] for r in reconcile(a, b).collect()} == {
        "x": True, "y": False, "z": False}


def test_reconciliation_per_role(spark, model):
    """Data tampered with in one role: only that role's rows and the total disagree."""
    ours = crosscheck.role_values(model)
    agreed = reconcile(ours, crosscheck.independent_roles(spark, model), ["papel"])
    assert {r["papel"] for r in agreed.collect()} == {"A", "B", "C", None}
    assert agreed.count() == 4 * len(crosscheck.ROLE_NAMES)
    other = model.replacing({"fato_tarefa": lambda: model["fato_tarefa"].withColumn(
        "horas_apontadas", F.expr("horas_apontadas + if(projeto_id = 'P3', 1, 0)"))})
    before = {(r["papel"], r["medida"]) for r in agreed.where("NOT confere").collect()}
    after = {(r["papel"], r["medida"]) for r in reconcile(
        ours, crosscheck.independent_roles(spark, other), ["papel"]).where("NOT confere").collect()}
    changed = after - before
    assert {papel for papel, _ in changed} == {"B", None}
    assert {m for papel, m in changed if papel == "B"} == {
        "Horas Apontadas", "% Orçamento Consumido"}
    missing = ours.where("NOT (papel <=> 'A' AND medida = 'Projetos')")
    lost = reconcile(missing, crosscheck.independent_roles(spark, model), ["papel"]).where(
        "NOT confere AND medida = 'Projetos'").collect()
    assert [r["papel"] for r in lost] == ["A"]


def test_roles_in_one_evaluation_equal_each_role_alone(model):
    names = ["Projetos", "Tarefas", "Tarefas Abertas", "Mudanças de Status"]
    together = values(measure(model, names, ["dim_projeto.portfolio"]))
    for role in ("A", "B", "C"):
        alone = tuple(measure(model, names, portfolio=role).first())
        assert together[role] == alone
        assert tuple(measure(secured(model, role), names).first()) == alone


def test_slicers_reach_rows_or_raise(model):
    only = {"dim_projeto.portfolio": ["A"]}
    assert reports.overdue(model, only).count() == 1
    assert reports.overdue(model, {"dim_projeto.portfolio": ["B"]}).count() == 0
    assert reports.overdue(model, {"fato_tarefa.status": ["Impedido"]}).count() == 0
    with pytest.raises(ValueError, match="does not reach"):
        reports.overdue(model, {"dim_data.ano": [2026]})
    with pytest.raises(ValueError, match="do not reach"):
        reports.at_risk(model, {"fato_tarefa.status": ["Fazendo"]})
    whole = reports.schedule(model, REF, [2026])
    assert 0 <= reports.schedule(model, REF, [2026], only).count() <= whole.count()
