"""Business labels: statuses, deadline states, schedule share, derived labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklens.functions.times import column, days_late
from worklens.schemas import FINAL_STAGES, ON_HOLD_LABEL, RUNNING_PROJECT, STAGES


def _stage_map(position: int) -> Column:
    pairs = [F.lit(part) for stage in STAGES for part in (stage[0], stage[position])]
    return F.create_map(*pairs)


def stage_order(stage: Column | str) -> Column:
    """Position of a stage in the flow; an unknown stage has none."""
    return _stage_map(2)[column(stage)]


def stage_category(stage: Column | str) -> Column:
    return _stage_map(1)[column(stage)]


def is_open(stage: Column | str) -> Column:
    return ~column(stage).isin(FINAL_STAGES)


def is_done(stage: Column | str) -> Column:
    return column(stage) == "Concluído"


def task_deadline_state(
    stage: Column | str, done: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    stage, done, deadline = column(stage), column(done), column(deadline)
    return (
        F.when(stage == "Arquivada", "Arquivada")
        .when(deadline.isNull(), "Sem prazo")
        .when(is_done(stage) & (done <= deadline), "Concluída no prazo")
        .when(is_done(stage), "Concluída com atraso")
        .when(deadline < column(ref), "Vencida")
        .otherwise("No prazo")
    )


def task_days_late(
    stage: Column | str, done: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    """Delay of done tasks at completion and of open tasks at the reference; archived has none."""
    return F.when(is_done(stage), days_late(column(done), deadline)).when(
        is_open(stage), days_late(column(ref), deadline)
    )


def project_status(state: Column | str, labels: Column | str, stage: Column | str) -> Column:
    state = column(state)
    return (
        F.when(state == "Arquivado", "Arquivado")
        .when(state == "Concluído", "Concluído")
        .when(F.array_contains(labels, ON_HOLD_LABEL), ON_HOLD_LABEL)
        .when(column(stage) == "Planejamento", "Planejamento")
        .otherwise("Em execução")
    )


def is_running(status: Column | str) -> Column:
    return column(status).isin(RUNNING_PROJECT)


def project_deadline_state(
    status: Column | str, done: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    """Done: on time only when the end is known to meet the deadline. Running: late past it."""
    status, deadline = column(status), column(deadline)
    on_time = F.coalesce(column(done) <= deadline, F.lit(False))
    past = F.coalesce(column(ref) > deadline, F.lit(False))
    return (
        F.when(status == "Concluído",
               F.when(on_time, "Concluído no prazo").otherwise("Concluído com atraso"))
        .when(is_running(status), F.when(past, "Atrasado").otherwise("No prazo"))
        .otherwise(status)
    )


def project_days_late(
    status: Column | str, done: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    counted = is_running(status) | is_done(status)
    return F.when(counted, days_late(F.coalesce(column(done), column(ref)), deadline))


def schedule_elapsed(
    status: Column | str, start: Column | str, deadline: Column | str, ref: Column | date
) -> Column:
    """Share of the planned span gone by at the reference; a zero-day plan has no share."""
    share = F.try_divide(F.datediff(column(ref), start), F.datediff(deadline, start))
    return F.when(is_running(status), F.round(share, 4))


def effort_deviation(stage: Column | str, logged: Column | str, estimate: Column | str) -> Column:
    return F.when(is_done(stage), F.round(column(logged) - column(estimate), 1))


def traffic_light(
    state: Column | str, labels: Column | str, start: Column | str, deadline: Column | str,
    done_share: Column | str, ref: Column | date
) -> Column:
    """Health of a project from its schedule and the share of its tasks that is done."""
    span = F.greatest(F.datediff(deadline, start), F.lit(1))
    gap = F.datediff(column(ref), start) / span - F.coalesce(column(done_share), F.lit(0.0))
    return (
        F.when(F.coalesce(column(state) != "Ativo", F.lit(True)), "Encerrado")
        .when(column(deadline) < column(ref), "Vermelho")
        .when(F.array_contains(labels, ON_HOLD_LABEL), "Amarelo")
        .when(gap > 0.05, "Amarelo")
        .otherwise("Verde")
    )


def hash_bucket(text: Column | str) -> Column:
    """Stable number from the first 32 bits of the text's SHA-256."""
    return F.conv(F.substring(F.sha2(column(text), 256), 1, 8), 16, 10).cast("bigint")


def origin(name: Column | str) -> Column:
    """Where an initiative came from: 40 % ideas, 15 % startups, the rest direct."""
    share = hash_bucket(name) % 100
    return F.when(share < 40, "Ideia").when(share < 55, "Startup").otherwise("Direto")


def origin_code(name: Column | str) -> Column:
    number = hash_bucket(name)
    return F.when(number % 100 < 40, F.concat(F.lit("IDE-"), 1000 + number % 9000)).when(
        number % 100 < 55, F.concat(F.lit("STA-"), 100 + number % 900)
    )
