"""Row-level security: a role sees one portfolio, and the facts that belong to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.plans.gold import Model


def secured(model: Model, portfolio: str) -> Model:
    """The model as a role sees it: projects filtered, tasks and visits through their keys.

    People, stages and days are not filtered. Both semi-joins follow unique keys of the smaller
    side; the visits of a hot task match one row and are split by the engine's skew handling.
    """
    def projects() -> DataFrame:
        return model["dim_projeto"].where(F.col("portfolio") == portfolio)

    def kept(name: str, key: str, parent: DataFrame) -> DataFrame:
        facts = model[name]
        return facts.join(parent.select(key), key, "left_semi").select(*facts.columns)

    secured_model = model.replacing({
        "dim_projeto": projects,
        "fato_tarefa": lambda: kept("fato_tarefa", "projeto_id", secured_model["dim_projeto"]),
        "fato_passagem_status":
            lambda: kept("fato_passagem_status", "tarefa_id", secured_model["fato_tarefa"]),
    })
    return secured_model
