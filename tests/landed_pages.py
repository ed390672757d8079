"""A small, hand-built landing area: pages of JSON with the dirt the engine must handle."""

from __future__ import annotations

import json
from pathlib import Path

RUN1, RUN2 = "20260901T060000Z", "20260930T060000Z"


def write_page(root: Path, resource: str, run: str, rows: list[dict], page: int = 1) -> Path:
    day = f"{run[:4]}-{run[4:6]}-{run[6:8]}"
    folder = root / resource / f"data_carga={day}"
    folder.mkdir(parents=True, exist_ok=True)
    target = folder / f"{run}_p{page:04d}.json"
    body = {"dados": rows, "_execucao": run, "pagina": page, "_modo": "completo", "proxima": None}
    target.write_text(json.dumps(body, ensure_ascii=False, indent=1), encoding="utf-8")
    return target


def write_meta(root: Path, run: str, ref: str) -> None:
    day = f"{run[:4]}-{run[4:6]}-{run[6:8]}"
    folder = root / "meta" / f"data_carga={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{run}.json").write_text(
        json.dumps({"versao": "1.0", "data_referencia": ref, "semente": 42}))


PORTFOLIOS = [
    {"id": 1, "nome": " Dados  & Analytics", "sigla": "da", "dono_id": "USR-001", "etapas": ["A"]},
    {"id": 2, "nome": "Inovação Aberta", "sigla": "IA", "dono_id": "USR-009", "etapas": None},
]
PEOPLE = [
    {"id": "USR-001", "nome": "Ana\tLima ", "email": "ANA@X.COM", "portfolio_id": 1,
     "cargo": "Gestora", "data_admissao": "2020-01-15", "ativo": None},
    {"id": "USR-002", "nome": "Bia", "email": "b@x.com", "portfolio_id": 2, "cargo": "",
     "data_admissao": "2021-99-01", "ativo": False},
    {"id": "USR-003", "nome": "Caio", "email": "c@x.com", "portfolio_id": 9, "cargo": "x",
     "data_admissao": None, "ativo": True},
]


def project(pid: str, **changes) -> dict:
    row = {
        "id": pid, "portfolio_id": 1, "nome": f"Projeto {pid}", "etapa": "Execução",
        "situacao": "Ativo", "etiquetas": None, "farol": "verde", "origem": "Ideia",
        "origem_id": "IDE-1", "gerente_id": "USR-001", "prioridade": "alta",
        "inicio": "2026-01-10", "limite": "2026-08-31", "concluido_em": None,
        "horas_orcadas": 100, "orcamento": 16000.0,
        "criado_em": "2026-01-10T09:00:00-03:00", "atualizado_em": "2026-01-10T09:00:00-03:00",
    }
    return {**row, **changes}


def task(tid: str, **changes) -> dict:
    row = {
        "id": tid, "projeto_id": "PRJ-001", "titulo": f"Tarefa {tid}  ", "etapa": "Fazendo",
        "situacao": "Em andamento", "etiquetas": ["x", "y"], "responsavel_id": "USR-001",
        "prioridade": "CRÍTICA", "tipo": "Análise", "estimativa_horas": 8.0,
        "horas_apontadas": 2.0, "criada_em": "2026-08-01T09:00:00-03:00", "limite": "2026-09-10",
        "concluida_em": None, "atualizado_em": "2026-08-03T09:00:00-03:00",
    }
    return {**row, **changes}


def move(eid: str, tid: str, before: str | None, after: str, when: str, who="USR-001") -> dict:
    return {"id": eid, "tarefa_id": tid, "etapa_anterior": before, "etapa_nova": after,
            "usuario_id": who, "ocorrido_em": when}


PROJECTS = [
    project("PRJ-001"),
    project("PRJ-002", portfolio_id=2, gerente_id="USR-002", situacao="Concluído",
            etapa="Concluído", farol="Encerrado", concluido_em="2026-07-01", prioridade="??"),
    project("PRJ-003", etiquetas=["Em espera"], limite="2026-01-10"),
    project("PRJ-004", farol="roxo"),
    project("PRJ-005", situacao=None),
    project("PRJ-006", limite="2025-01-01"),
    project("PRJ-007", gerente_id=None),
    project("PRJ-008", etapa="Planejamento", limite="2026-01-10", inicio="2026-01-10", farol=None),
]
TASKS = [
    task("TSK-00001", etapa="Concluído", concluida_em="2026-08-11T09:00:00-03:00",
         horas_apontadas=10.0, atualizado_em="2026-08-11T09:00:00-03:00"),
    task("TSK-00002"),
    task("TSK-00003", limite=None, etapa="Impedido"),
    task("TSK-00004", etapa="Em Pausa"),
    task("TSK-00005", projeto_id="PRJ-004"),
    task("TSK-00006", horas_apontadas=-3.0),
    task("TSK-00007", responsavel_id=None),
    task("TSK-00008", projeto_id="PRJ-002", etapa="Arquivada", prioridade="\tmédia\n"),
    task("TSK-00009", estimativa_horas=-1.0, horas_apontadas=-1.0),
    task("TSK-00010", etapa="Backlog", limite="2026-12-01"),  # no moves yet
]
MOVES = [
    move("EVT-000001", "TSK-00001", None, "Backlog", "2026-08-01T09:00:00-03:00"),
    move("EVT-000002", "TSK-00001", "Backlog", "Fazendo", "2026-08-03T09:00:00-03:00"),
    move("EVT-000003", "TSK-00001", "Fazendo", "Em revisão", "2026-08-05T09:00:00-03:00"),
    move("EVT-000004", "TSK-00001", "Em revisão", "Fazendo", "2026-08-06T09:00:00-03:00"),
    move("EVT-000005", "TSK-00001", "Fazendo", "Impedido", "2026-08-07T09:00:00-03:00"),
    move("EVT-000006", "TSK-00001", "Impedido", "Concluído", "2026-08-11T09:00:00-03:00"),
    move("EVT-000007", "TSK-00002", None, "Backlog", "2026-08-01T09:00:00-03:00"),
    move("EVT-000008", "TSK-00002", "Backlog", "Fazendo", "2026-08-03T23:30:00-03:00"),
    move("EVT-000009", "TSK-00003", None, "Impedido", "2026-08-01T09:00:00-03:00"),
    move("EVT-000010", "TSK-00005", None, "Fazendo", "2026-08-01T09:00:00-03:00"),
    move("EVT-000011", "TSK-00002", "Fazendo", "Nada", "2026-08-04T09:00:00-03:00"),
    move("EVT-000012", "TSK-00002", "Fazendo", "Impedido", "2026-08-04T09:00:00-03:00", "USR-404"),
    move("EVT-000013", "TSK-00008", None, "Arquivada", "2026-08-02T09:00:00-03:00"),
]
RESOURCES = {
    "portfolios": PORTFOLIOS, "usuarios": PEOPLE, "projetos": PROJECTS, "tarefas": TASKS,
    "movimentacoes": MOVES,
}


def write_all(root: Path, run: str = RUN1, ref: str = "2026-09-30") -> Path:
    for name, rows in RESOURCES.items():
        half = max(1, len(rows) // 2)
        write_page(root, name, run, rows[:half], 1)
        write_page(root, name, run, rows[half:], 2)
    write_meta(root, run, ref)
    return root
