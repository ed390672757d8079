"""Incremental landing gives what one full load gives, also after a crash and in any file order."""

import pytest
from landed_pages import (
    MOVES,
    PEOPLE,
    PORTFOLIOS,
    PROJECTS,
    RUN1,
    RUN2,
    TASKS,
    move,
    project,
    task,
    write_all,
    write_page,
)
from pyspark.sql import functions as F

from worklens.operators.compare import diff_summary, table_diff
from worklens.plans.refresh import refresh_silver, silver_from_records
from worklens.plans.silver import candidates, current
from worklens.sources.landing import latest_meta, read_pages, records
from worklens.sources.watermark import changed_since, run_log, window_start
from worklens.streaming import landing_stream as S

CHANGED_TASK = task("TSK-00002", etapa="Concluído", atualizado_em="2026-09-20T10:00:00-03:00",
                    concluida_em="2026-09-20T10:00:00-03:00")
NEW_MOVE = move("EVT-000020", "TSK-00002", "Fazendo", "Concluído", "2026-09-20T10:00:00-03:00")
NEW_PROJECT = project("PRJ-020", atualizado_em="2026-09-21T10:00:00-03:00")


def second_run(root):
    """What the next load sends: snapshots whole, changes only, the overlap repeated."""
    write_page(root, "portfolios", RUN2, PORTFOLIOS)
    write_page(root, "usuarios", RUN2, PEOPLE)
    write_page(root, "projetos", RUN2, [NEW_PROJECT])
    write_page(root, "tarefas", RUN2, [CHANGED_TASK, TASKS[0]])
    write_page(root, "movimentacoes", RUN2, [NEW_MOVE, MOVES[5]])


def full_load(root):
    tasks = [CHANGED_TASK if t["id"] == "TSK-00002" else t for t in TASKS]
    write_page(root, "portfolios", RUN2, PORTFOLIOS)
    write_page(root, "usuarios", RUN2, PEOPLE)
    write_page(root, "projetos", RUN2, [*reversed(PROJECTS), NEW_PROJECT])
    write_page(root, "tarefas", RUN2, tasks[::-1])
    write_page(root, "movimentacoes", RUN2, [NEW_MOVE, *MOVES])


def assert_same(a, b):
    for name in a:
        row = diff_summary(table_diff(a[name], b[name])).first()
        assert (row["so_em_a"], row["so_em_b"]) == (0, 0), name


def silver(spark, root):
    return candidates({n: records(read_pages(spark, str(root), n)) for n in S.LANDED})


def test_incremental_equals_full(spark, tmp_path):
    incremental, full = tmp_path / "a", tmp_path / "b"
    write_all(incremental)
    second_run(incremental)
    full_load(full)
    assert_same(silver(spark, incremental), silver(spark, full))


@pytest.fixture()
def folders(tmp_path):
    return tmp_path / "root", str(tmp_path / "target"), str(tmp_path / "state")


def marks(df):
    return {r["recurso"]: str(r["marca"]) for r in df.collect()}


def test_stream_lands_each_page_once(spark, folders, tmp_path):
    root, target, state = folders
    write_all(root)
    first = marks(S.land_run(spark, str(root), target, RUN1, state))
    assert first == {"projetos": "2026-01-10 12:00:00", "tarefas": "2026-08-11 12:00:00",
                     "movimentacoes": "2026-08-11 12:00:00"}
    assert S.landed(spark, target, "tarefas").count() == len(TASKS)
    second_run(root)
    second = marks(S.land_run(spark, str(root), target, RUN2, state))
    assert second["tarefas"] == "2026-09-20 13:00:00"
    assert S.landed(spark, target, "tarefas").count() == len(TASKS) + 2
    S.land_run(spark, str(root), target, "20261001T000000Z", state)
    assert S.landed(spark, target, "tarefas").count() == len(TASKS) + 2
    full = tmp_path / "full"
    full_load(full)
    streamed = candidates({n: S.landed(spark, target, n) for n in S.LANDED})
    assert_same(streamed, silver(spark, full))


def test_streamed_records_refresh_the_same_silver(spark, folders):
    root, target, state = folders
    write_all(root)
    bad = root / "tarefas" / "data_carga=2026-09-01" / f"{RUN1}_p0009.json"
    bad.write_text('{"dados": [ {"id": ')
    S.land_run(spark, str(root), target, RUN1, state)
    log = {r["recurso"]: r for r in spark.read.parquet(f"{target}/_controle/execucoes").collect()}
    assert (log["tarefas"]["paginas"], log["tarefas"]["registros"]) == (2, len(TASKS))
    assert log["tarefas"]["modo"] == "completo" and len(log) == 5
    second_run(root)
    S.land_run(spark, str(root), target, RUN2, state)
    runs = spark.read.parquet(f"{target}/_controle/execucoes").where(f"_execucao = '{RUN2}'")
    log = {r["recurso"]: r for r in runs.collect()}
    assert str(log["tarefas"]["desde"]) == "2026-08-11 11:55:00"
    assert (log["tarefas"]["modo"], log["usuarios"]["modo"]) == ("incremental", "completo")
    stored = {n: S.stored(spark, target, n) for n in S.LANDED}
    meta = latest_meta(read_pages(spark, str(root), "meta"))
    counts = silver_from_records(spark, stored, meta)
    streamed = [tuple(r) for r in spark.table("silver_rejeitados").select("id", "motivo").collect()]
    assert counts["silver_rejeitados"] == 14  # the unreadable page is one of them
    refresh_silver(spark, str(root))
    direct = [tuple(r) for r in spark.table("silver_rejeitados").select("id", "motivo").collect()]
    assert sorted(streamed) == sorted(direct)


def test_failed_run_leaves_the_marks_and_is_repeated(spark, folders, monkeypatch):
    root, target, state = folders
    write_all(root)
    S.land_run(spark, str(root), target, RUN1, state)
    second_run(root)
    real = S.land_new_pages

    def crash(spark_, root_, resource, *rest):
        if resource == "movimentacoes":
            raise RuntimeError("lost")
        real(spark_, root_, resource, *rest)

    monkeypatch.setattr(S, "land_new_pages", crash)
    with pytest.raises(RuntimeError):
        S.land_run(spark, str(root), target, RUN2, state)
    assert marks(S.saved_marks(spark, target))["tarefas"] == "2026-08-11 12:00:00"
    monkeypatch.setattr(S, "land_new_pages", real)
    S.land_run(spark, str(root), target, RUN2, state)
    assert marks(S.saved_marks(spark, target))["movimentacoes"] == "2026-09-20 13:00:00"
    assert S.landed(spark, target, "tarefas").count() == len(TASKS) + 2


def test_replayed_batch_replaces_its_folder(spark, folders, tmp_path):
    root, target, state = folders
    write_all(root)
    S.land_new_pages(spark, str(root), "tarefas", target, state)
    replay = tmp_path / "state2"  # a checkpoint that never heard of the batch
    S.land_new_pages(spark, str(root), "tarefas", target, str(replay))
    assert S.landed(spark, target, "tarefas").count() == len(TASKS)


def test_window_is_strict_and_overlaps(spark):
    moments = ["2026-09-01 09:54:59", "2026-09-01 09:55:00", "2026-09-01 09:55:01",
               "2026-09-01 10:00:00", None]
    df = spark.createDataFrame([(m,) for m in moments], "t string").select(
        F.col("t").cast("timestamp").alias("t"))
    marks_df = df.agg(F.max("t").alias("marca")).select(F.lit("tarefas").alias("recurso"), "marca")
    kept = [str(r["t"]) for r in changed_since(df, "tarefas", "t", marks_df).collect()]
    # a record without a time is never taken for an old one
    assert kept == ["2026-09-01 09:55:01", "2026-09-01 10:00:00", "None"]
    assert changed_since(df, "projetos", "t", marks_df).count() == 5
    assert changed_since(df, "tarefas", "t", None).count() == 5
    assert str(window_start(marks_df).first()["desde"]) == "2026-09-01 09:55:00"


def test_an_empty_page_is_logged(spark, folders):
    root, target, state = folders
    write_all(root)
    S.land_run(spark, str(root), target, RUN1, state)
    second_run(root)
    write_page(root, "projetos", RUN2, [])  # an incremental resource without changes
    S.land_run(spark, str(root), target, RUN2, state)
    runs = spark.read.parquet(f"{target}/_controle/execucoes").where(f"_execucao = '{RUN2}'")
    log = {r["recurso"]: r for r in runs.collect()}
    assert (log["projetos"]["paginas"], log["projetos"]["registros"]) == (1, 0)
    assert S.landed(spark, target, "projetos").count() == len(PROJECTS)


def test_a_run_reads_only_its_own_files(spark, folders):
    root, target, state = folders
    write_all(root)
    S.land_run(spark, str(root), target, RUN1, state)
    second_run(root)
    S.land_run(spark, str(root), target, RUN2, state)
    own = S.stored_run(spark, target, "tarefas", RUN2)
    assert own.count() == 2
    files = {r[0] for r in own.select(F.input_file_name()).distinct().collect()}
    assert files and all(f"_execucao={RUN2}" in f for f in files)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_execucao" in plan


def test_a_broken_snapshot_deletes_nobody(spark, folders):
    root, target, state = folders
    write_all(root)
    S.land_run(spark, str(root), target, RUN1, state)
    write_page(root, "usuarios", RUN2, PEOPLE[:1])  # the run broke off after its first page
    S.land_new_pages(spark, str(root), "usuarios", target, f"{state}/landing")
    people = S.landed(spark, target, "usuarios")
    assert current(people, "usuarios").count() == 1
    assert current(people, "usuarios", S.committed_runs(spark, target)).count() == len(PEOPLE)


def test_run_log(spark, tmp_path):
    root = write_all(tmp_path)
    pages = read_pages(spark, str(root), "tarefas").select(
        F.lit("tarefas").alias("recurso"), "_execucao", "_arquivo",
        F.size("dados").alias("registros"))
    row = run_log(pages).first()
    assert (row["paginas"], row["registros"], row["modo"]) == (2, len(TASKS), "completo")
