"""Data contracts: landed resources, value domains and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: landed resources (every field nullable) -------------------------------------
RESOURCES = {
    "portfolios": "id int, nome string, sigla string, dono_id string, etapas array<string>",
    "usuarios": (
        "id string, nome string, email string, portfolio_id int, cargo string, "
        "data_admissao string, ativo boolean"
    ),
    "projetos": (
        "id string, portfolio_id int, nome string, etapa string, situacao string, "
        "etiquetas array<string>, farol string, origem string, origem_id string, "
        "gerente_id string, prioridade string, inicio string, limite string, "
        "concluido_em string, horas_orcadas int, orcamento double, criado_em string, "
        "atualizado_em string"
    ),
    "tarefas": (
        "id string, projeto_id string, titulo string, etapa string, situacao string, "
        "etiquetas array<string>, responsavel_id string, prioridade string, tipo string, "
        "estimativa_horas double, horas_apontadas double, criada_em string, limite string, "
        "concluida_em string, atualizado_em string"
    ),
    "movimentacoes": (
        "id string, tarefa_id string, etapa_anterior string, etapa_nova string, "
        "usuario_id string, ocorrido_em string"
    ),
    "meta": "versao string, data_referencia string, semente bigint",
}

# change column of each incremental resource; the others arrive as full snapshots
CHANGE_COLUMN = {
    "projetos": "atualizado_em",
    "tarefas": "atualizado_em",
    "movimentacoes": "ocorrido_em",
}

# --- fixed values: domains ---------------------------------------------------------------------
PRIORITIES = ["Baixa", "Média", "Alta", "Crítica"]
PRIORITY_UNKNOWN = "Não informada"
PROJECT_STATES = ["Ativo", "Concluído", "Arquivado"]
LIGHTS = ["Verde", "Amarelo", "Vermelho", "Encerrado"]
ON_HOLD_LABEL = "Em espera"
TIME_ZONE = "America/Sao_Paulo"

# stage, category, order
STAGES = [
    ("Backlog", "Não iniciada", 1),
    ("A fazer", "Não iniciada", 2),
    ("Fazendo", "Em andamento", 3),
    ("Impedido", "Em andamento", 4),
    ("Em revisão", "Em andamento", 5),
    ("Concluído", "Concluída", 6),
    ("Arquivada", "Arquivada", 7),
]
STAGE_NAMES = [stage for stage, _, _ in STAGES]
FINAL_STAGES = ["Concluído", "Arquivada"]
RUNNING_PROJECT = ["Em execução", "Planejamento"]

# --- fixed values: star schema, exact names, types and order -----------------------------------
GOLD = {
    "fato_tarefa": (
        "tarefa_id string, projeto_id string, responsavel_id string, titulo string, tipo string, "
        "prioridade string, status string, situacao string, etiquetas string, data_criacao date, "
        "criada_em timestamp, data_inicio_execucao date, data_conclusao date, "
        "concluida_em timestamp, data_limite date, estimativa_horas double, "
        "horas_apontadas double, desvio_horas double, aberta boolean, lead_time_dias double, "
        "ciclo_dias double, idade_dias double, dias_na_etapa_atual double, qtd_bloqueios bigint, "
        "dias_bloqueada double, qtd_retrabalho bigint, situacao_prazo string, dias_atraso int"
    ),
    "fato_passagem_status": (
        "passagem_id string, tarefa_id string, projeto_id string, sequencia int, "
        "status_anterior string, status string, ordem_etapa int, pessoa_id string, "
        "entrada_em timestamp, saida_em timestamp, data_entrada date, dias_na_etapa double, "
        "etapa_atual boolean, etapa_final boolean"
    ),
    "dim_projeto": (
        "projeto_id string, projeto string, portfolio string, gerente string, prioridade string, "
        "status string, etapa string, situacao string, farol string, origem string, "
        "origem_id string, etiquetas string, data_inicio date, data_limite date, "
        "data_conclusao date, horas_orcadas int, orcamento double, dias_planejados int, "
        "situacao_prazo string, dias_atraso int, percentual_prazo_decorrido double"
    ),
    "dim_pessoa": (
        "pessoa_id string, pessoa string, portfolio string, cargo string, ativo boolean, "
        "data_admissao date"
    ),
    "dim_status": "status string, categoria string, ordem int",
    "dim_data": (
        "data date, ano int, mes int, mes_nome string, mes_ano string, ano_mes int, "
        "trimestre string, semana_inicio date, dia_semana int, dia_semana_nome string, "
        "dia_util boolean, ate_referencia boolean"
    ),
    "ref_parametros": "data_referencia date, processado_em timestamp",
}

# --- fixed values: security roles, role name -> portfolio it may see ----------------------------
ROLES = {
    "TransformacaoDigital": "Transformação Digital",
    "DadosAnalytics": "Dados & Analytics",
    "ExcelenciaOperacional": "Excelência Operacional",
    "CrescimentoComercial": "Crescimento Comercial",
    "PessoasCultura": "Pessoas & Cultura",
    "ExperienciaCliente": "Experiência do Cliente",
    "SustentabilidadeESG": "Sustentabilidade & ESG",
    "InovacaoAberta": "Inovação Aberta",
}

# volatile columns, left out of every table comparison
VOLATILE = ["processado_em"]


def gold_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(GOLD[table])
