"""Runs the registered queries next to their SQL and compares names, types and values.

    python -m verification.check /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import time

import duckdb

from claimwright.session import session
from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return str(value)


def _sorted(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, connection, folder: str, name: str) -> str:
    """Empty when both engines agree, else what differs."""
    df = QUERIES[name](spark, folder)
    ours = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        return "" if ours else "no rows"
    result = connection.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = _sorted(df.columns, ours), _sorted(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    folder, only = sys.argv[1], sys.argv[2:]
    spark = session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in only or QUERIES:
        started = time.time()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        kind = "sql " if name in ORACLE else "rows"
        print(f"{name:32s} {kind} {time.time() - started:6.2f}s {problem[:900] or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
