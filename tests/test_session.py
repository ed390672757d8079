"""Session settings, saved tables and current versions."""

import pytest
from pyspark.sql import functions as F

from worklens.operators.latest import latest_per_key, latest_snapshot, newest_row
from worklens.session import (
    INITIAL_PARTITIONS, PARTITIONS_PER_CORE, RUNTIME, shared_folder, tune,
)
from worklens.sources.tables import save_table


def test_tune_sets_sql_options_and_leaves_given_partitions_alone(spark):
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME.items())
    first = spark.conf.get(INITIAL_PARTITIONS)
    assert int(first) == spark.sparkContext.defaultParallelism * PARTITIONS_PER_CORE
    try:
        spark.conf.set(INITIAL_PARTITIONS, "11")
        tune(spark)
        assert spark.conf.get(INITIAL_PARTITIONS) == "11"
    finally:
        spark.conf.set(INITIAL_PARTITIONS, first)


class Session:
    """Just enough of a session to hold one setting."""

    def __init__(self, folder):
        self.conf = self
        self.folder = folder

    def get(self, name, default):
        return self.folder if name == "spark.checkpoint.dir" and self.folder else default


def test_shared_folder_comes_from_the_session():
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session(None))
    assert shared_folder(Session(None), "/tmp/x/") == "/tmp/x"
    assert shared_folder(Session("/shared/state/"), "/tmp/x") == "/shared/state"


def test_save_replaces_rows_and_schema_and_counts(spark):
    assert save_table(spark.range(5), "saved_once") == 5
    assert save_table(spark.range(3).select(F.col("id").cast("string").alias("k")), "saved_once") == 3
    assert spark.table("saved_once").columns == ["k"]
    assert save_table(spark.range(0), "saved_once") == 0


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame([
        ("a", 1, "r1", "x"), ("a", 2, "r1", "y"), ("a", 2, "r2", "z"), ("b", 1, "r2", "p"),
        ("b", 1, "r2", "q"), ("b", None, "r3", "n"), (None, 1, "r1", "k"),
    ], "id string, v int, _execucao string, t string")


def test_newest_version_then_run_then_every_column(versions):
    current = latest_per_key(versions, ["id"], [F.col("v").desc(), F.col("_execucao").desc()])
    assert {(r["id"], r["t"]) for r in current.collect()} == {("a", "z"), ("b", "q"), (None, "k")}


def test_snapshot_can_be_limited_to_committed_runs(spark, versions):
    assert {r["t"] for r in latest_snapshot(versions).collect()} == {"n"}
    committed = spark.createDataFrame([("r1",), ("r2",)], "_execucao string")
    assert {r["t"] for r in latest_snapshot(versions, committed=committed).collect()} == {
        "z", "p", "q"}
    assert latest_snapshot(versions.where("false")).count() == 0


def test_newest_row_of_nothing(versions):
    assert newest_row(versions, "_execucao").count() == 1
    assert newest_row(versions.where("false"), "_execucao").count() == 0
