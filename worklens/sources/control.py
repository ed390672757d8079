"""Control log: what each run leaves, in a folder of its own, folded into a snapshot every few runs.

A read opens the newest whole snapshot and the runs after it, however many runs there ever were. One
writer at a time, as for the runs themselves. A reader who listed folders before a compaction may fail
on a missing file and has to read again; it never sees a part of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: So many runs beside the snapshot are folded into the next one.
TAIL = 10

RUN = "execucao"
SNAPSHOTS = "_resumo"  # hidden from whoever reads the folder of runs itself
WHOLE = "_SUCCESS"  # written last by Spark's committer


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _folders(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def _delete(spark: SparkSession, folder: str) -> None:
    fs, path = _path(spark, folder)
    fs.delete(path, True)


def tail(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the runs that no snapshot has taken over yet."""
    return [name for name in _folders(spark, folder) if name.startswith(f"{RUN}=")]


def snapshots(spark: SparkSession, folder: str) -> list[str]:
    """Names of the whole snapshots, newest last; one whose write broke off is none."""
    found = []
    for name in _folders(spark, f"{folder}/{SNAPSHOTS}"):
        fs, marker = _path(spark, f"{folder}/{SNAPSHOTS}/{name}/{WHOLE}")
        if fs.exists(marker):
            found.append(name)
    return found


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """All rows with their run in ``execucao``, None before the first run.

    A run found in both places, after a repeat or a compaction that broke off before it tidied up,
    counts as its own folder has it.
    """
    runs, whole = tail(spark, folder), snapshots(spark, folder)
    reader = spark.read.schema(f"{schema}, {RUN} string")
    parts = []
    if whole:
        names = [name.removeprefix(f"{RUN}=") for name in runs]
        kept = reader.parquet(f"{folder}/{SNAPSHOTS}/{whole[-1]}")
        parts.append(kept.where(~F.col(RUN).isin(names)) if names else kept)
    if runs:
        paths = [f"{folder}/{name}" for name in runs]
        parts.append(reader.option("basePath", folder).parquet(*paths))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def append_run(spark: SparkSession, folder: str, run: str, rows: DataFrame, schema: str) -> DataFrame:
    """Write what one run leaves, a repeat replacing it; then fold the tail if it has grown long.

    Returns the rows of the run.
    """
    rows.write.mode("overwrite").parquet(f"{folder}/{RUN}={run}")
    compact(spark, folder, schema)
    return read_log(spark, folder, schema).where(F.col(RUN) == run).drop(RUN)


def compact(spark: SparkSession, folder: str, schema: str) -> None:
    """Fold runs and snapshot into a new snapshot once ``TAIL`` runs lie beside the last one.

    Only when the new snapshot is whole do the folders it took over go; until then nothing is lost,
    and afterwards nothing counts twice.
    """
    runs = tail(spark, folder)
    if len(runs) < TAIL:
        return
    before = _folders(spark, f"{folder}/{SNAPSHOTS}")
    number = 1 + max((int(name.removeprefix("n=")) for name in before), default=0)
    name = f"n={number:09d}"
    # a few rows a run, hence one file
    read_log(spark, folder, schema).coalesce(1).write.parquet(f"{folder}/{SNAPSHOTS}/{name}")
    if name not in snapshots(spark, folder):
        raise OSError(f"snapshot {name} of {folder} has no {WHOLE}; its runs stay as they are")
    for run in runs:
        _delete(spark, f"{folder}/{run}")
    for old in before:
        _delete(spark, f"{folder}/{SNAPSHOTS}/{old}")
