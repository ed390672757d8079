"""The control log: snapshot and tail hold what all runs left, whatever breaks off in between."""

import pytest
from pyspark.sql import functions as F

from worklens.sources import control as C

SCHEMA = "recurso string, marca int"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "marcas")


def append(spark, folder, number, value=None):
    value = number if value is None else value
    rows = spark.range(1, numPartitions=1).select(
        F.lit("tarefas").alias("recurso"), F.lit(value).cast("int").alias("marca"))
    return C.append_run(spark, folder, f"{number:04d}", rows, SCHEMA)


def values(spark, folder):
    return sorted((r["execucao"], r["marca"]) for r in C.read_log(spark, folder, SCHEMA).collect())


def expected(count):
    return [(f"{n:04d}", n) for n in range(count)]


def test_nothing_before_the_first_run(spark, folder):
    assert C.read_log(spark, folder, SCHEMA) is None
    assert [r["marca"] for r in append(spark, folder, 7).collect()] == [7]
    assert values(spark, folder) == [("0007", 7)]  # the name stays a text


def test_a_read_opens_the_snapshot_and_a_short_tail(spark, folder):
    for number in range(200):
        append(spark, folder, number)
    assert values(spark, folder) == expected(200)
    assert len(C.tail(spark, folder)) < C.TAIL and len(C.snapshots(spark, folder)) == 1
    opened = C.read_log(spark, folder, SCHEMA).select(F.input_file_name().alias("f")).distinct()
    assert opened.count() <= 1 + C.TAIL


def test_a_repeated_run_counts_once(spark, folder):
    for number in range(C.TAIL):
        append(spark, folder, number)
    assert C.tail(spark, folder) == []
    append(spark, folder, 3, 33)
    want = [(run, 33 if run == "0003" else n) for run, n in expected(C.TAIL)]
    assert values(spark, folder) == want
    for number in range(C.TAIL, 2 * C.TAIL - 1):
        append(spark, folder, number)
    assert C.tail(spark, folder) == [] and dict(values(spark, folder))["0003"] == 33
    assert len(values(spark, folder)) == 2 * C.TAIL - 1


@pytest.mark.parametrize("step", ["write", "delete"])
def test_a_failed_compaction_loses_nothing(spark, folder, monkeypatch, step):
    for number in range(2 * C.TAIL - 1):
        append(spark, folder, number)

    def lost(*_):
        raise RuntimeError("lost")

    if step == "write":  # the snapshot is there without its last file
        monkeypatch.setattr(C, "WHOLE", "_OTHER")
        fs, path = C._path(spark, f"{folder}/{C.SNAPSHOTS}/n=000000001/_OTHER")
        fs.create(path).close()
        with pytest.raises(OSError, match="stay as they are"):
            append(spark, folder, 2 * C.TAIL - 1)
        fs, path = C._path(spark, f"{folder}/{C.SNAPSHOTS}/n=000000002/_SUCCESS")
        fs.delete(path, False)
    else:
        monkeypatch.setattr(C, "_delete", lost)
        with pytest.raises(RuntimeError):
            append(spark, folder, 2 * C.TAIL - 1)
    monkeypatch.undo()
    assert values(spark, folder) == expected(2 * C.TAIL)
    append(spark, folder, 2 * C.TAIL)
    assert values(spark, folder) == expected(2 * C.TAIL + 1)
    assert C.tail(spark, folder) == [] and len(C.snapshots(spark, folder)) == 1
