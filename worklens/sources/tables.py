"""Catalog tables: read, and full refresh with the row count taken while writing.

A refresh writes a new version beside the one readers see and swaps the name last. A write that fails
leaves the old version, its rows and its schema, as they were.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What the versions of a table are called: the name, this, and a number of their own.
VERSION = "__v"


def save_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
    violations: Mapping[str, Column] | None = None,
) -> int:
    """Replace a table and its schema; rows are counted by the write itself, not by a second scan.

    ``name`` is a view over the newest version. The version before it is kept, so that readers who
    opened it finish; older ones are dropped after the swap.

    ``violations`` are aggregates that must be zero. The same write counts them, and where one is not
    zero the new version goes before anybody has seen it.
    """
    spark = df.sparkSession
    before = versions(spark, name)
    version = f"{name}{VERSION}{uuid4().hex}"
    seen = Observation(f"rows_{uuid4().hex}")
    broken = [counted.alias(check) for check, counted in (violations or {}).items()]
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *broken).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    current = current_version(spark, name)
    try:
        writer.saveAsTable(version)
        failed = [check for check in violations or {} if seen.get[check]]
        if failed:
            raise AssertionError(f"inconsistent rows for {name}: {failed}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    if current is None:  # a plain table of an earlier layout makes room for the view
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # one change of the catalog: a reader sees the old version or the new one
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in before:
        if old != current:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return seen.get["rows"]


def versions(spark: SparkSession, name: str) -> list[str]:
    """Names of the stored versions of a table."""
    rows = spark.sql(f"SHOW TABLES LIKE '{name}{VERSION}*'").collect()
    return sorted(r["tableName"] for r in rows)


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that the view of this name shows; None before the first."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[0]["data_type"].rsplit(" ", 1)[-1].strip("`") if rows else None
