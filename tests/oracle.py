"""Compares a registered query with its SQL on the same tables.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FAMILY = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "decimal(38,0)": "DECIMAL(38,0)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """What differs: column names, types, then exact values regardless of row order."""
    ours = run(spark, sf_dir)
    theirs = con.sql(sql)
    names = sorted(ours.columns)
    if names != sorted(theirs.columns):
        return [f"columns {names} and {sorted(theirs.columns)}"]
    types = {n: str(t) for n, t in zip(theirs.columns, theirs.types)}
    found = [
        f"type of {name}: {kind} and {types[name]}" for name, kind in ours.dtypes
        if FAMILY.get(kind, kind) != types[name]
    ]
    a = sorted(map(repr, (tuple(r[n] for n in names) for r in ours.collect())))
    order = [theirs.columns.index(n) for n in names]
    b = sorted(repr(tuple(row[i] for i in order)) for row in theirs.fetchall())
    if len(a) != len(b):
        found.append(f"{len(a)} rows and {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        found.append(f"{len(only_a)} rows only in ours, e.g. {only_a[:2]}; "
                     f"{len(only_b)} only in SQL, e.g. {only_b[:2]}")
    if not a:
        found.append("no rows")
    return found


def main() -> int:
    from conftest import new_session

    import __spark_entry__ as entry
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, failed = new_session(), connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if name not in oracle or (len(sys.argv) > 2 and name not in sys.argv[2:]):
            continue
        start = time.time()
        try:
            found = differences(spark, con, run, oracle[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     ",
              flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
