"""The plans the operators must keep: pruned scans, no nested loops, no Python in the rows."""

import io
import re
from contextlib import redirect_stdout

import pytest

from worklens.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    text = io.StringIO()
    with redirect_stdout(text):
        REGISTRY[name].run(spark, SF).explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join_or_python_rows(spark, name):
    text = plan(spark, name)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                     "FlatMapGroups", "Exchange SinglePartition, REPARTITION"):
        assert unwanted not in text, unwanted


@pytest.mark.parametrize("name", ["stage_visits", "history_rollup", "run_log", "audit_history"])
def test_windows_are_partitioned(spark, name):
    text = plan(spark, name)
    keys = re.findall(r"windowspecdefinition\((\w+)#\d+L?,", text)
    assert keys and set(keys) <= {"tarefa_id", "recurso"}
    assert text.count("windowspecdefinition(") == len(keys)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    tree = plan(spark, "latest_per_key").split("\n\n")[0]
    steps = re.findall(r"WindowGroupLimit|Exchange", tree)
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "join_semi")
    assert "EqualTo(o_orderstatus,P)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text
    assert "GreaterThan(ts,2024-01-1" in plan(spark, "incremental_window")


def test_history_is_ordered_once(spark):
    """Position, next and previous value share one sort."""
    text = plan(spark, "stage_visits")
    tree = text.split("\n\n")[0]
    assert tree.count("Window (") <= 2  # events, and the slots of hot keys


def test_visits_fold_before_they_meet_tasks(spark):
    text = re.sub(r"#\d+L?", "", plan(spark, "measures_by_axis"))
    assert re.search(r"Keys \[1\]: \[tarefa_id\]\nFunctions \[1\]: \[partial_sum\(1\)\]", text)
    assert re.search(r"Keys \[1\]: \[projeto_id\]\nFunctions \[1\]: \[partial_sum\(mudancas\)\]",
                     text)
