"""A refresh that fails leaves what readers see; versions come and go."""

import pytest
from pyspark.sql import functions as F

from worklens.sources.tables import current_version, save_table, versions


@pytest.fixture
def name(spark):
    name = "tabela_atomica"
    yield name
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for version in versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()))


def test_replaces_rows_and_schema(spark, name):
    assert save_table(spark.range(3).toDF("a"), name) == 3
    assert save_table(spark.createDataFrame([(1, "x"), (2, "y")], "b int, c string"), name,
                      partition_by=("c",)) == 2
    assert rows(spark, name) == [(1, "x"), (2, "y")] and spark.table(name).columns == ["b", "c"]


def test_failing_write_leaves_the_old_rows(spark, name):
    save_table(spark.range(3).toDF("a"), name)
    broken = spark.range(100).select(F.expr(
        "if(id = 99, raise_error('no'), id)").cast("string").alias("other"))
    with pytest.raises(Exception, match="no"):
        save_table(broken, name)
    assert rows(spark, name) == [(0,), (1,), (2,)] and spark.table(name).columns == ["a"]
    assert versions(spark, name) == [current_version(spark, name)]
    assert save_table(spark.range(1).toDF("a"), name) == 1 and rows(spark, name) == [(0,)]


def test_rows_that_break_a_rule_are_never_shown(spark, name):
    positive = {"a não negativo": F.count_if(F.col("a") < 0)}
    assert save_table(spark.range(3).toDF("a"), name, violations=positive) == 3
    with pytest.raises(AssertionError, match="a não negativo"):
        save_table(spark.range(-1, 5).toDF("a"), name, violations=positive)
    assert rows(spark, name) == [(0,), (1,), (2,)]
    assert versions(spark, name) == [current_version(spark, name)]
    assert save_table(spark.range(0).toDF("a"), name, violations=positive) == 0


def test_failing_swap_leaves_the_old_rows(spark, name, monkeypatch):
    """A schema change that gets as far as the swap and no further."""
    save_table(spark.range(3).toDF("a"), name)
    sql = type(spark).sql

    def no_swap(self, text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("lost")
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", no_swap)
    with pytest.raises(RuntimeError):
        save_table(spark.createDataFrame([("x",)], "b string"), name)
    monkeypatch.undo()
    assert rows(spark, name) == [(0,), (1,), (2,)]
    save_table(spark.range(2).toDF("a"), name)
    assert rows(spark, name) == [(0,), (1,)]


def test_open_readers_finish(spark, name):
    """What was opened before a refresh is read to its end; two refreshes later only two are left."""
    save_table(spark.range(3).toDF("a"), name)
    opened = spark.table(name)
    save_table(spark.range(5).toDF("a"), name)
    assert opened.count() == 3 and spark.table(name).count() == 5
    save_table(spark.table(name).where("a > 1"), name)  # also from itself
    save_table(spark.table(name).where("a > 2"), name)
    assert rows(spark, name) == [(3,), (4,)] and len(versions(spark, name)) == 2


def test_plain_table_becomes_a_view(spark, name):
    spark.range(2).toDF("a").write.saveAsTable(name)
    assert current_version(spark, name) is None
    save_table(spark.range(4).toDF("a"), name)
    assert spark.table(name).count() == 4
