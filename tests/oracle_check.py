"""Run a registered query on Spark and its SQL on DuckDB, and compare the rows."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type of each Spark type that results use.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def differences(frame, connection, sql):
    """What tells the two results apart; empty if nothing does."""
    columns = sorted(frame.columns)
    answer = connection.execute(sql)
    theirs = {name: str(kind) for name, kind in ((d[0], d[1]) for d in answer.description)}
    found = []
    if sorted(theirs) != columns:
        return [f"columns {columns} against {sorted(theirs)}"]
    kinds = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    if kinds != theirs:
        found.append(f"types {kinds} against {theirs}")
    order = [name for name in theirs]
    expected = Counter(
        tuple(_plain(row[order.index(c)]) for c in columns) for row in answer.fetchall()
    )
    actual = Counter(tuple(_plain(row[c]) for c in columns) for row in frame.collect())
    if expected != actual:
        found.append(f"{actual.total()} rows against {expected.total()}")
        found.append(f"only in Spark: {list((actual - expected).items())[:3]} of {(actual - expected).total()}")
        found.append(f"only in SQL: {list((expected - actual).items())[:3]} of {(expected - actual).total()}")
    return found


if __name__ == "__main__":
    import __spark_entry__ as contract
    from tomegauge.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = connect(folder)
    oracles = contract.oracle_sql()
    bad = 0
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = build(spark, folder)
            found = differences(frame, connection, oracles[name]) if name in oracles else [f"no SQL, {frame.count()} rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1200], flush=True)
    print(f"{bad} bad")
