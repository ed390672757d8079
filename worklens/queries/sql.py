"""The warehouse-to-portfolio mapping as plain SQL, written apart from the Spark one."""

FLOW_END = "TIMESTAMP '2024-02-01 02:59:59'"  # last second of the reference day, in UTC


def hundredths(seconds: str) -> str:
    return f"CAST(({seconds} * 100 + 43200) // 86400 AS BIGINT)"


def days(seconds: str) -> str:
    return f"({hundredths(seconds)} / 100)"


BASE = f"""
WITH moves AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 19, '0') AS id,
         CAST(user_id * 100 + (day(ts) - 1) // 7 AS VARCHAR) AS tarefa_id,
         CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'A fazer'
              WHEN event_type = 'view' THEN 'Em revisão'
              WHEN event_type = 'signup' THEN 'Backlog'
              WHEN event_type = 'click' THEN 'Fazendo'
              WHEN event_type = 'error' THEN 'Impedido'
              WHEN event_type = 'purchase' THEN 'Concluído' END AS etapa,
         CAST(user_id AS VARCHAR) AS usuario_id, ts
  FROM events
), visits0 AS (
  SELECT *, lag(etapa) OVER w AS anterior, row_number() OVER w AS sequencia,
         lead(ts) OVER w AS saida
  FROM moves WINDOW w AS (PARTITION BY tarefa_id ORDER BY ts, id)
), visits AS (
  SELECT *, etapa IN ('Concluído', 'Arquivada') AS final, saida IS NULL AS atual,
         CASE WHEN etapa NOT IN ('Concluído', 'Arquivada')
              THEN date_diff('second', ts, coalesce(saida, {FLOW_END})) END AS segundos
  FROM visits0
), rollup AS (
  SELECT tarefa_id,
         min(ts) FILTER (WHERE etapa = 'Fazendo') AS inicio,
         count(*) FILTER (WHERE etapa = 'Impedido') AS bloqueios,
         CAST(coalesce(sum({hundredths('segundos')}) FILTER (WHERE etapa = 'Impedido'), 0)
              AS BIGINT) AS bloqueada,
         count(*) FILTER (WHERE etapa = 'Fazendo' AND anterior = 'Em revisão') AS retrabalho,
         max(ts) AS ultima, min(ts) AS criada, max(usuario_id) AS projeto_id,
         count(*) AS passagens
  FROM visits GROUP BY tarefa_id
), tickets AS (
  SELECT r.*, v.etapa AS status,
         v.etapa NOT IN ('Concluído', 'Arquivada') AS aberta,
         CASE WHEN v.etapa = 'Concluído' THEN r.ultima END AS conclusao,
         CAST(CAST(r.projeto_id AS BIGINT) % 10 AS VARCHAR) AS responsavel_id
  FROM rollup r JOIN visits v ON v.tarefa_id = r.tarefa_id AND v.atual
), flow_tasks AS (
  SELECT *, CAST(criada - INTERVAL 3 HOUR AS DATE) AS data_criacao,
         CAST(conclusao - INTERVAL 3 HOUR AS DATE) AS data_conclusao,
         CASE WHEN status = 'Concluído'
              THEN {hundredths("date_diff('second', criada, conclusao)")} END AS lead_c,
         CASE WHEN status = 'Concluído'
              THEN {hundredths("date_diff('second', inicio, conclusao)")} END AS ciclo_c,
         CASE WHEN aberta
              THEN {hundredths(f"date_diff('second', criada, {FLOW_END})")} END AS idade_c,
         CASE WHEN aberta
              THEN {hundredths(f"date_diff('second', ultima, {FLOW_END})")} END AS etapa_c
  FROM tickets
), hours AS (
  SELECT l_orderkey, sum(l_quantity) AS estimativa,
         CAST(sum(CAST(round(l_quantity * (1 + l_tax) * 100) AS BIGINT)) AS BIGINT) AS centesimos,
         CAST(max(l_suppkey) AS VARCHAR) AS responsavel_id
  FROM lineitem GROUP BY l_orderkey
), kept AS (
  SELECT *, CAST(o_orderdate AS DATE) AS criada,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INTEGER) AS pronta
  FROM orders
), tasks0 AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS tarefa_id,
         CAST(o_custkey AS VARCHAR) AS projeto_id,
         'Entrega ' || CAST(o_orderkey % 7 AS VARCHAR) AS titulo,
         list_extract(['Funcionalidade', 'Correção', 'Análise'],
                      CAST(o_orderkey % 3 + 1 AS INTEGER)) AS tipo,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'Crítica' WHEN '2' THEN 'Alta'
              WHEN '3' THEN 'Média' WHEN '4' THEN 'Não informada' ELSE 'Baixa' END AS prioridade,
         CASE WHEN o_orderstatus = 'F' AND pronta <= DATE '2001-08-31' THEN 'Concluído'
              WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 0 THEN 'Arquivada'
              WHEN o_orderstatus = 'P' THEN 'Impedido' ELSE 'Fazendo' END AS status,
         criada AS data_criacao,
         CASE left(o_orderpriority, 1) WHEN '1' THEN criada + 30 WHEN '2' THEN criada + 60
              WHEN '3' THEN criada + 90 WHEN '5' THEN criada + 120 END AS data_limite,
         CASE WHEN o_orderstatus = 'F' AND pronta <= DATE '2001-08-31' THEN pronta END
           AS data_conclusao,
         h.estimativa, h.centesimos, h.responsavel_id
  FROM kept LEFT JOIN hours h ON h.l_orderkey = o_orderkey
), tasks AS (
  SELECT *, status NOT IN ('Concluído', 'Arquivada') AS aberta,
         CASE WHEN status = 'Arquivada' THEN 'Arquivada'
              WHEN data_limite IS NULL THEN 'Sem prazo'
              WHEN status = 'Concluído' AND data_conclusao <= data_limite
                THEN 'Concluída no prazo'
              WHEN status = 'Concluído' THEN 'Concluída com atraso'
              WHEN data_limite < DATE '2001-08-31' THEN 'Vencida'
              ELSE 'No prazo' END AS situacao_prazo,
         CASE WHEN status = 'Arquivada' THEN NULL
              WHEN data_limite IS NULL THEN 0
              WHEN status = 'Concluído'
                THEN greatest(date_diff('day', data_limite, data_conclusao), 0)
              ELSE greatest(date_diff('day', data_limite, DATE '2001-08-31'), 0) END
           AS dias_atraso
  FROM tasks0
), spans AS (
  SELECT o_custkey, min(criada) AS inicio, max(criada) AS fim FROM kept GROUP BY o_custkey
), attributes AS (
  SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS projeto_id, c_name AS projeto,
         c_mktsegment AS portfolio, CAST(c_nationkey AS VARCHAR) AS gerente_id,
         CASE WHEN c_custkey % 10 = 0 THEN 'Arquivado' WHEN c_custkey % 10 <= 3 THEN 'Concluído'
              ELSE 'Ativo' END AS situacao,
         c_custkey % 6 = 5 AS espera,
         list_extract(['Verde', 'Amarelo', 'Vermelho', 'Encerrado'],
                      CAST(c_custkey % 4 + 1 AS INTEGER)) AS farol,
         CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) AS sorteio,
         CAST(100 + c_custkey % 50 * 10 AS INTEGER) AS horas_orcadas, c_acctbal AS orcamento
  FROM customer
), attributes2 AS (
  SELECT *,
         CASE WHEN situacao = 'Concluído' THEN 'Concluído' WHEN k % 4 = 0 THEN 'Planejamento'
              WHEN k % 4 = 1 THEN 'Implantação' ELSE 'Execução' END AS etapa,
         CASE WHEN sorteio % 100 < 40 THEN 'Ideia' WHEN sorteio % 100 < 55 THEN 'Startup'
              ELSE 'Direto' END AS origem,
         CASE WHEN situacao <> 'Ativo' THEN situacao WHEN espera THEN 'Em espera'
              WHEN k % 4 = 0 THEN 'Planejamento' ELSE 'Em execução' END AS status
  FROM attributes
), projects AS (
  SELECT a.*, s.inicio AS data_inicio,
         CASE WHEN k % 13 <> 0 THEN s.inicio + CAST(1500 + k % 11 * 100 AS INTEGER) END
           AS data_limite,
         CASE WHEN situacao = 'Concluído' THEN s.fim END AS data_conclusao
  FROM attributes2 a LEFT JOIN spans s ON s.o_custkey = a.k
), dim AS (
  SELECT *,
         CASE WHEN status = 'Concluído' THEN
                CASE WHEN data_conclusao <= data_limite THEN 'Concluído no prazo'
                     ELSE 'Concluído com atraso' END
              WHEN status IN ('Em execução', 'Planejamento') THEN
                CASE WHEN data_limite < DATE '2001-08-31' THEN 'Atrasado' ELSE 'No prazo' END
              ELSE status END AS situacao_prazo,
         CASE WHEN status IN ('Concluído', 'Em execução', 'Planejamento') THEN
                greatest(coalesce(date_diff('day', data_limite,
                         coalesce(data_conclusao, DATE '2001-08-31')), 0), 0) END AS dias_atraso,
         date_diff('day', data_inicio, data_limite) AS dias_planejados
  FROM projects
), flow_dim AS (
  SELECT *, DATE '2023-06-01' + CAST(k % 240 AS INTEGER) AS data_inicio FROM attributes2
)
"""
