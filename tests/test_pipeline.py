"""Landing to gold on hand-built pages: exact rows, quarantine, deletion, schema."""

from datetime import date, datetime

import pytest
from landed_pages import MOVES, PEOPLE, PROJECTS, RUN1, RUN2, project, task, write_all, write_page
from pyspark.sql import functions as F

from worklens.operators.quarantine import all_rejects, cascade, reject_summary, valid
from worklens.plans.checks import calendar_coverage, gold_checks, require_consistent
from worklens.plans.gold import open_model
from worklens.plans.refresh import refresh, refresh_gold, refresh_silver
from worklens.plans.silver import candidates, unparsed
from worklens.schemas import GOLD, gold_schema
from worklens.sources.landing import bad_pages, read_pages, records


@pytest.fixture(scope="module")
def counts(spark, tmp_path_factory):
    root = write_all(tmp_path_factory.mktemp("bronze"))
    return refresh(spark, str(root))


@pytest.fixture(scope="module")
def model(spark, counts):
    return open_model(spark)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rejects_name_the_first_broken_rule(spark, counts):
    assert rows(spark.table("silver_rejeitados"), "tabela", "id", "motivo") == [
        ("movimentacoes", "EVT-000010", "tarefa_id sem correspondente"),
        ("movimentacoes", "EVT-000011", "etapa desconhecida"),
        ("movimentacoes", "EVT-000012", "usuario_id sem correspondente"),
        ("projetos", "PRJ-004", "farol desconhecido"),
        ("projetos", "PRJ-005", "situação de projeto desconhecida"),
        ("projetos", "PRJ-006", "limite antes do início"),
        ("projetos", "PRJ-007", "gerente_id sem correspondente"),
        ("tarefas", "TSK-00004", "etapa de tarefa desconhecida"),
        ("tarefas", "TSK-00005", "projeto_id sem correspondente"),
        ("tarefas", "TSK-00006", "horas negativas"),
        ("tarefas", "TSK-00007", "responsavel_id sem correspondente"),
        ("tarefas", "TSK-00009", "estimativa negativa"),
        ("usuarios", "USR-003", "portfolio_id sem correspondente"),
    ]
    assert counts["silver_rejeitados"] == 13


def test_reject_keeps_the_record(spark, counts):
    record = spark.table("silver_rejeitados").where("id = 'TSK-00006'").first()["registro"]
    assert '"horas_apontadas":-3.0' in record and "concluida_em" not in record


def test_reject_summary(spark, counts):
    summary = reject_summary(spark.table("silver_rejeitados"))
    assert sum(r["linhas"] for r in summary.collect()) == 13


def test_clean_values(spark, counts):
    assert rows(spark.table("silver_portfolios"), "nome", "sigla") == [
        ("Dados & Analytics", "DA"), ("Inovação Aberta", "IA")]
    people = {r["id"]: r for r in spark.table("silver_usuarios").collect()}
    assert people["USR-001"]["nome"] == "Ana Lima" and people["USR-001"]["ativo"] is True
    assert people["USR-001"]["email"] == "ana@x.com"
    assert people["USR-002"]["cargo"] is None and people["USR-002"]["data_admissao"] is None
    tasks = {r["id"]: r for r in spark.table("silver_tarefas").collect()}
    assert tasks["TSK-00008"]["prioridade"] == "Média"
    assert tasks["TSK-00001"]["titulo"] == "Tarefa TSK-00001"


def test_schema_is_the_contract(model):
    for name in GOLD:
        got = [(f.name, f.dataType) for f in model[name].schema]
        assert got == [(f.name, f.dataType) for f in gold_schema(name)], name


def test_task_facts(model):
    tasks = {r["tarefa_id"]: r for r in model["fato_tarefa"].collect()}
    assert sorted(tasks) == [
        "TSK-00001", "TSK-00002", "TSK-00003", "TSK-00008", "TSK-00010"]
    done = tasks["TSK-00001"]
    assert (done["lead_time_dias"], done["ciclo_dias"]) == (10.0, 8.0)
    assert (done["qtd_bloqueios"], done["dias_bloqueada"], done["qtd_retrabalho"]) == (1, 4.0, 1)
    assert (done["desvio_horas"], done["situacao_prazo"], done["dias_atraso"]) == (
        2.0, "Concluída no prazo", 0)
    assert done["criada_em"] == datetime(2026, 8, 1, 9) and not done["aberta"]
    late = tasks["TSK-00002"]
    assert (late["situacao_prazo"], late["dias_atraso"]) == ("Vencida", 20)
    assert late["data_inicio_execucao"] == date(2026, 8, 3) and late["lead_time_dias"] is None
    assert late["idade_dias"] == 60.62  # to 23:59:59 of the reference day
    assert late["etiquetas"] == "x, y"
    free = tasks["TSK-00003"]
    assert (free["situacao_prazo"], free["dias_atraso"]) == ("Sem prazo", 0)
    archived = tasks["TSK-00008"]
    assert (archived["situacao_prazo"], archived["dias_atraso"], archived["aberta"]) == (
        "Arquivada", None, False)
    unmoved = tasks["TSK-00010"]
    assert (unmoved["qtd_bloqueios"], unmoved["dias_bloqueada"], unmoved["qtd_retrabalho"]) == (
        0, 0.0, 0)
    assert unmoved["dias_na_etapa_atual"] is None and unmoved["idade_dias"] == 60.62


def test_visits(model):
    visits = model["fato_passagem_status"].where("tarefa_id = 'TSK-00001'").orderBy("sequencia")
    got = [(r["sequencia"], r["status"], r["dias_na_etapa"], r["etapa_atual"]) for r in
           visits.collect()]
    assert got == [
        (1, "Backlog", 2.0, False), (2, "Fazendo", 2.0, False), (3, "Em revisão", 1.0, False),
        (4, "Fazendo", 1.0, False), (5, "Impedido", 4.0, False), (6, "Concluído", None, True)]


def test_projects(model):
    projects = {r["projeto_id"]: r for r in model["dim_projeto"].collect()}
    assert sorted(projects) == ["PRJ-001", "PRJ-002", "PRJ-003", "PRJ-008"]
    assert projects["PRJ-001"]["situacao_prazo"] == "Atrasado"
    assert projects["PRJ-001"]["dias_atraso"] == 30
    assert projects["PRJ-001"]["gerente"] == "Ana Lima"
    assert projects["PRJ-002"]["situacao_prazo"] == "Concluído no prazo"
    assert projects["PRJ-002"]["prioridade"] == "Não informada"
    assert projects["PRJ-003"]["status"] == "Em espera"
    assert projects["PRJ-003"]["dias_atraso"] is None
    same_day = projects["PRJ-008"]
    assert (same_day["status"], same_day["dias_planejados"]) == ("Planejamento", 0)
    assert same_day["percentual_prazo_decorrido"] is None


def test_calendar(model):
    days = model["dim_data"]
    assert days.count() == 365
    day = days.where("data = date'2026-09-30'").first()
    assert (day["mes_ano"], day["trimestre"], day["dia_semana_nome"], day["ate_referencia"]) == (
        "set/26", "T3", "qua", True)
    assert day["semana_inicio"] == date(2026, 9, 28)


def test_checks_hold(model):
    assert [r["violacoes"] for r in gold_checks(model).collect()] == [0] * 7
    assert [r["violacoes"] for r in calendar_coverage(model).collect()] == [0, 0]


def test_a_failed_check_stops_the_refresh(model):
    broken = model.replacing({"dim_pessoa": lambda: model["dim_pessoa"].limit(0)})
    with pytest.raises(AssertionError, match="responsável"):
        require_consistent(broken)


def test_checks_read_each_table_once(model):
    plan = gold_checks(model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 5 and "Join" not in plan


def violations(model):
    return {r["checagem"]: r["violacoes"] for r in gold_checks(model).collect()}


def test_checks_count_rows_without_keys(model):
    """A NULL key has no parent, even where the dimension holds a NULL; repeated rows count."""
    tasks = model["fato_tarefa"]
    no_key = tasks.where("tarefa_id = 'TSK-00001'").withColumns({
        "projeto_id": F.lit(None).cast("string"), "responsavel_id": F.lit(None).cast("string"),
        "data_criacao": F.lit(None).cast("date"), "tarefa_id": F.lit(None).cast("string")})
    projects = model["dim_projeto"]
    nobody = projects.limit(1).withColumn("projeto_id", F.lit(None).cast("string"))
    found = violations(model.replacing({
        "fato_tarefa": lambda: tasks.unionByName(no_key).unionByName(no_key),
        "dim_projeto": lambda: projects.unionByName(nobody)}))
    assert found == {
        "toda tarefa tem projeto": 2, "todo responsável existe": 2,
        "status da tarefa = última passagem": 0, "uma etapa atual por tarefa": 0,
        "tempos não negativos": 0, "ciclo ≤ lead time": 0, "calendário cobre todas as datas": 2}


def test_checks_count_pairs_of_task_and_current_visit(model):
    visits = model["fato_passagem_status"]
    current = visits.where("tarefa_id = 'TSK-00001' AND etapa_atual")
    other = current.withColumn("status", F.lit("Fazendo"))
    unknown = current.withColumn("status", F.lit(None).cast("string"))
    found = violations(model.replacing({
        "fato_passagem_status": lambda: visits.unionByName(current).unionByName(other)
        .unionByName(other).unionByName(unknown)}))
    assert found["status da tarefa = última passagem"] == 2
    assert found["uma etapa atual por tarefa"] == 1


def test_checks_of_an_empty_model(model):
    empty = model.replacing(
        {name: lambda name=name: model[name].limit(0) for name in model.names})
    assert set(violations(empty).values()) == {0}
    assert [r["violacoes"] for r in calendar_coverage(empty).collect()] == [0, 0]


def test_a_task_that_breaks_a_rule_is_never_shown(spark, counts, tmp_path, monkeypatch):
    """The write of the fact counts the rule; what readers see stays as it was."""
    before = rows(spark.table("fato_tarefa"), "tarefa_id")
    silver = spark.table("silver_tarefas").withColumn(
        "criada_em", F.when(F.col("id") == "TSK-00001", F.expr("criada_em + INTERVAL 9 DAYS"))
        .otherwise(F.col("criada_em")))
    real = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: (
        silver if name == "silver_tarefas" else real(self, name)))
    with pytest.raises(AssertionError, match="ciclo"):
        refresh_gold(spark)
    monkeypatch.undo()
    assert rows(spark.table("fato_tarefa"), "tarefa_id") == before
    assert violations(open_model(spark))["ciclo ≤ lead time"] == 0


def test_deleted_person_leaves_and_takes_the_tasks(spark, tmp_path):
    root = write_all(tmp_path)
    write_page(root, "usuarios", RUN2, [p for p in PEOPLE if p["id"] != "USR-002"])
    landed = {n: records(read_pages(spark, str(root), n)) for n in
              ("portfolios", "usuarios", "projetos", "tarefas", "movimentacoes")}
    flagged = cascade(candidates(landed))
    assert rows(valid(flagged["usuarios"]), "id") == [("USR-001",)]
    reasons = dict(rows(all_rejects(flagged), "id", "motivo"))
    assert reasons["PRJ-002"] == "gerente_id sem correspondente"
    assert reasons["TSK-00008"] == "projeto_id sem correspondente"
    assert reasons["EVT-000013"] == "tarefa_id sem correspondente"


def test_hot_foreign_keys_give_the_same_quarantine(spark, tmp_path):
    root = write_all(tmp_path)
    landed = {n: records(read_pages(spark, str(root), n)) for n in
              ("portfolios", "usuarios", "projetos", "tarefas", "movimentacoes")}
    tables = candidates(landed)
    results = [
        rows(all_rejects(cascade(tables, hot_rows=n)), "tabela", "id", "motivo")
        for n in (1, 1_000_000)
    ]
    assert results[0] == results[1]


def test_newer_version_wins_and_ties_are_settled(spark, tmp_path):
    root = write_all(tmp_path)
    write_page(root, "tarefas", RUN2, [
        task("TSK-00002", titulo="nova", atualizado_em="2026-09-02T09:00:00-03:00"),
        task("TSK-00003", titulo="velha", atualizado_em="2026-07-01T09:00:00-03:00"),
        task("TSK-00008", titulo="b"), task("TSK-00008", titulo="a")])
    current = candidates({n: records(read_pages(spark, str(root), n)) for n in
                          ("portfolios", "usuarios", "projetos", "tarefas", "movimentacoes")})
    titles = dict(rows(current["tarefas"], "id", "titulo"))
    assert titles["TSK-00002"] == "nova" and titles["TSK-00003"] == "Tarefa TSK-00003"
    assert titles["TSK-00008"] == "b"
    assert len(titles) == 10


def test_unreadable_page_is_reported(spark, tmp_path):
    root = write_all(tmp_path)
    bad = root / "tarefas" / "data_carga=2026-09-01" / f"{RUN1}_p0009.json"
    bad.write_text('{"dados": [ {"id": ')
    pages = read_pages(spark, str(root), "tarefas")
    assert records(pages).count() == 10
    found = bad_pages(pages, "tarefas").collect()
    assert len(found) == 1 and found[0]["id"].endswith("_p0009.json")
    assert refresh_silver(spark, str(root))["silver_rejeitados"] == 14


def test_load_date_prunes_pages(spark, tmp_path):
    root = write_all(tmp_path)
    write_page(root, "projetos", RUN2, [project("PRJ-100")])
    recent = read_pages(spark, str(root), "projetos", since="2026-09-15")
    assert [r["id"] for r in records(recent).collect()] == ["PRJ-100"]
    assert "PartitionFilters: [isnotnull(data_carga" in recent._jdf.queryExecution().toString()


def test_unparsed_texts_are_counted(spark, tmp_path):
    root = write_all(tmp_path)
    people = records(read_pages(spark, str(root), "usuarios"))
    assert rows(unparsed(people, "usuarios"), "coluna", "falhas") == [("data_admissao", 1)]


def test_fixture_sizes():
    assert (len(PROJECTS), len(MOVES)) == (8, 13)
