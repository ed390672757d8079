"""Column functions on hand-written values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from worklens.functions import labels as L
from worklens.functions import text as X
from worklens.functions import times as T
from worklens.schemas import PRIORITIES, PRIORITY_UNKNOWN

REF = date(2026, 9, 30)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("raw", "clean"), [
    ("  a  b ", "a b"), ("\ta\n\nb\t", "a b"), (" \t ", None), ("", None), (None, None),
])
def test_squeeze(spark, raw, clean):
    assert one(spark, X.squeeze(F.lit(raw).cast("string"))) == clean


@pytest.mark.parametrize(("raw", "value"), [
    ("ALTA", "Alta"), ("\tmédia ", "Média"), ("crítica", "Crítica"),
    ("urgente", "Não informada"), (None, "Não informada"),
])
def test_domain(spark, raw, value):
    assert one(spark, X.in_domain(F.lit(raw).cast("string"), PRIORITIES, PRIORITY_UNKNOWN)) == value


@pytest.mark.parametrize(("column", "text"), [
    (lambda: X.number_br(F.lit(1234567)), "1.234.567"),
    (lambda: X.number_br(F.lit(1234.56), 1), "1.234,6"),
    (lambda: X.number_br(F.lit(2.5)), "3"),
    (lambda: X.percent_br(F.lit(0.125), 1), "12,5%"),
    (lambda: X.percent_br(F.lit(0.285)), "29%"),
    (lambda: X.signed_percent_br(F.lit(0.312), 1), "+31,2%"),
    (lambda: X.signed_percent_br(F.lit(-0.2)), "-20%"),
    (lambda: X.signed_percent_br(F.lit(0.001)), "0%"),
    (lambda: X.whole_br(F.lit(None).cast("bigint")), "0"),
])
def test_pt_br_numbers(spark, column, text):
    assert one(spark, column()) == text


def test_instants_and_days(spark):
    assert one(spark, T.instant(F.lit("2026-08-01T23:30:00-03:00"))) == datetime(2026, 8, 2, 2, 30)
    assert one(spark, T.day(F.lit("2026-08-01T23:30:00-03:00"))) == date(2026, 8, 1)
    assert one(spark, T.instant(F.lit("x"))) is None
    assert one(spark, T.day(F.lit("2026-13-01"))) is None
    wall = T.local(T.instant(F.lit("2026-08-01T23:30:00-03:00")))
    assert one(spark, wall) == datetime(2026, 8, 1, 23, 30)
    assert one(spark, T.end_of_day(REF)) == datetime(2026, 10, 1, 2, 59, 59)


@pytest.mark.parametrize(("seconds", "value"), [
    (0, 0.0), (86400, 1.0), (432, 0.01), (431, 0.0), (-432, -0.01), (129600, 1.5),
])
def test_days_round_half_away_from_zero(spark, seconds, value):
    start = F.lit(datetime(2026, 1, 1))
    assert one(spark, T.days_between(start, start + F.expr(f"INTERVAL {seconds} SECONDS"))) == value


@pytest.mark.parametrize(("day", "moved"), [
    (date(2026, 10, 2), date(2026, 10, 2)), (date(2026, 10, 3), date(2026, 10, 5)),
    (date(2026, 10, 4), date(2026, 10, 5)),
])
def test_next_business_day(spark, day, moved):
    assert one(spark, T.next_business_day(day)) == moved


@pytest.mark.parametrize(("stage", "done", "deadline", "state", "late"), [
    ("Arquivada", None, date(2026, 1, 1), "Arquivada", None),
    ("Fazendo", None, None, "Sem prazo", 0),
    ("Concluído", date(2026, 1, 1), date(2026, 1, 1), "Concluída no prazo", 0),
    ("Concluído", date(2026, 1, 3), date(2026, 1, 1), "Concluída com atraso", 2),
    ("Concluído", date(2026, 1, 3), None, "Sem prazo", 0),
    ("Fazendo", None, date(2026, 9, 29), "Vencida", 1),
    ("Fazendo", None, date(2026, 9, 30), "No prazo", 0),
])
def test_task_deadline(spark, stage, done, deadline, state, late):
    args = (F.lit(stage), F.lit(done).cast("date"), F.lit(deadline).cast("date"), REF)
    assert one(spark, L.task_deadline_state(*args)) == state
    assert one(spark, L.task_days_late(*args)) == late


@pytest.mark.parametrize(("status", "done", "deadline", "state", "late"), [
    ("Concluído", date(2026, 1, 1), date(2026, 1, 1), "Concluído no prazo", 0),
    ("Concluído", None, date(2026, 1, 1), "Concluído com atraso", 272),
    ("Concluído", date(2026, 1, 1), None, "Concluído com atraso", 0),
    ("Em execução", None, date(2026, 9, 20), "Atrasado", 10),
    ("Planejamento", None, None, "No prazo", 0),
    ("Em espera", None, date(2020, 1, 1), "Em espera", None),
    ("Arquivado", None, date(2020, 1, 1), "Arquivado", None),
])
def test_project_deadline(spark, status, done, deadline, state, late):
    args = (F.lit(status), F.lit(done).cast("date"), F.lit(deadline).cast("date"), REF)
    assert one(spark, L.project_deadline_state(*args)) == state
    assert one(spark, L.project_days_late(*args)) == late


@pytest.mark.parametrize(("state", "labels", "stage", "status"), [
    ("Arquivado", ["Em espera"], "Planejamento", "Arquivado"),
    ("Concluído", ["Em espera"], "Concluído", "Concluído"),
    ("Ativo", ["Em espera"], "Planejamento", "Em espera"),
    ("Ativo", [], "Planejamento", "Planejamento"),
    ("Ativo", [], "Implantação", "Em execução"),
])
def test_project_status(spark, state, labels, stage, status):
    tags = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    assert one(spark, L.project_status(F.lit(state), tags, F.lit(stage))) == status


def test_schedule_without_length_has_no_share(spark):
    day = F.lit(date(2026, 9, 1))
    assert one(spark, L.schedule_elapsed(F.lit("Em execução"), day, day, REF)) is None


@pytest.mark.parametrize(("state", "labels", "deadline", "share", "light"), [
    ("Concluído", [], date(2027, 1, 1), 1.0, "Encerrado"),
    ("Ativo", [], date(2026, 9, 29), 1.0, "Vermelho"),
    ("Ativo", ["Em espera"], date(2026, 12, 31), 1.0, "Amarelo"),
    ("Ativo", [], date(2026, 10, 10), 0.90, "Verde"),
    ("Ativo", [], date(2026, 10, 10), 0.80, "Amarelo"),
])
def test_traffic_light(spark, state, labels, deadline, share, light):
    tags = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    start = F.lit(date(2026, 7, 2))  # 90 of 100 days gone by at the reference for October 10th
    got = one(spark, L.traffic_light(
        F.lit(state), tags, start, F.lit(deadline), F.lit(share), REF))
    assert got == light


def test_unknown_stage_has_no_order(spark):
    assert one(spark, L.stage_order(F.lit("Em revisão"))) == 5
    assert one(spark, L.stage_order(F.lit("Em Pausa"))) is None
