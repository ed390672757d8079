"""Row rules and foreign keys: flag once, then split into valid rows and rejects."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.operators.skew import HOT_ROWS, heavy_keys, skew_join
from worklens.schemas import LIGHTS, PROJECT_STATES, STAGE_NAMES

REASON = "motivo"
Rule = tuple[Column, str]


def outside(name: str, domain: Sequence[str]) -> Column:
    """Value not in a closed domain; NULL leaves the predicate undecided."""
    return ~F.col(name).isin(list(domain))


def row_rules(table: str) -> list[Rule]:
    """Rules of a silver table, in the order their reasons take precedence."""
    # fixed values: rules and their reasons
    rules = {
        "projetos": [
            (F.col("situacao").isNull() | outside("situacao", PROJECT_STATES),
             "situação de projeto desconhecida"),
            (outside("farol", LIGHTS), "farol desconhecido"),
            (F.col("limite") < F.col("inicio"), "limite antes do início"),
        ],
        "tarefas": [
            (F.col("etapa").isNull() | outside("etapa", STAGE_NAMES),
             "etapa de tarefa desconhecida"),
            (F.col("estimativa_horas") < 0, "estimativa negativa"),
            (F.col("horas_apontadas") < 0, "horas negativas"),
        ],
        "movimentacoes": [
            (F.col("etapa_nova").isNull() | outside("etapa_nova", STAGE_NAMES),
             "etapa desconhecida"),
        ],
    }
    return rules.get(table, [])


# fixed values: child table, its column, parent table; parents first, so orphans cascade downwards
FOREIGN_KEYS = [
    ("usuarios", "portfolio_id", "portfolios"),
    ("projetos", "portfolio_id", "portfolios"),
    ("projetos", "gerente_id", "usuarios"),
    ("tarefas", "projeto_id", "projetos"),
    ("tarefas", "responsavel_id", "usuarios"),
    ("movimentacoes", "tarefa_id", "tarefas"),
    ("movimentacoes", "usuario_id", "usuarios"),
]


def first_violation(rules: Sequence[Rule]) -> Column:
    """Reason of the first broken rule, NULL for a clean row; an undecided rule is not broken."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def flag_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, first_violation(rules))


def flag_orphans(
    flagged: DataFrame, column: str, parents: DataFrame, parent_key: str = "id",
    row_id: Sequence[str] = ("id",), hot_rows: int = HOT_ROWS, counted: DataFrame | None = None,
    heavy: Mapping[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Give rows without a partner in ``parents`` a reason, unless an earlier one stands.

    A NULL key is an orphan. ``parents`` holds each key once. ``counted`` and ``heavy`` as in
    ``skew_join``.
    """
    known = parents.select(F.col(parent_key).alias(column), F.lit(True).alias("_known"))
    checked = skew_join(flagged, known, column, "left", row_id, hot_rows, counted, heavy)
    orphan = F.when(F.col("_known").isNull(), F.lit(f"{column} sem correspondente"))
    return checked.select(
        *[F.col(c) for c in flagged.columns if c != REASON],
        F.coalesce(F.col(REASON), orphan).alias(REASON),
    )


def valid(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON).isNull()).drop(REASON)


def rejects(flagged: DataFrame, table: str, row_id: str = "id") -> DataFrame:
    """Rejected rows with their reason and the original record as JSON."""
    record = [c for c in flagged.columns if c != REASON]
    return flagged.where(F.col(REASON).isNotNull()).select(
        F.lit(table).alias("tabela"),
        F.col(row_id).cast("string").alias("id"),
        F.col(REASON),
        F.to_json(F.struct(*record)).alias("registro"),
    )


def cascade(
    tables: Mapping[str, DataFrame],
    keys: Sequence[tuple[str, str, str]] = tuple(FOREIGN_KEYS),
    rules: Callable[[str], Sequence[Rule]] = row_rules,
    stage: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
    hot_rows: int = HOT_ROWS,
    sources: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Flag every table, each foreign key against the parents that survived so far.

    ``tables`` is in parent-first order. ``stage`` may write a flagged table and return it read
    back, so that children, valid rows and rejects all reuse one computation. ``sources`` are the
    rows the tables were made from, where hot keys are cheaper to count.
    """
    flagged: dict[str, DataFrame] = {}
    for name, df in tables.items():
        current = flag_rules(df, rules(name))
        own = [(column, parent) for child, column, parent in keys if child == name]
        # the hot keys of all foreign keys of a table are counted in one pass
        heavy = heavy_keys((sources or tables)[name], [c for c, _ in own], hot_rows) if own else {}
        for column, parent in own:
            current = flag_orphans(
                current, column, valid(flagged[parent]), hot_rows=hot_rows, heavy=heavy)
        flagged[name] = stage(name, current)
    return flagged


def all_rejects(flagged: Mapping[str, DataFrame]) -> DataFrame:
    parts = [rejects(df, name) for name, df in flagged.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def reject_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("tabela", REASON).agg(F.count(F.lit(1)).alias("linhas"))
