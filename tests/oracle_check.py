"""Run registered queries against their SQL twins: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normalize(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, name: str, function, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    df = function(spark, folder)
    left = normalize(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    right = normalize(columns, relation.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return f"{len(left)} vs {len(right)} rows; spark only {only_left}; sql only {only_right}"[:900]


def main() -> None:
    import __spark_entry__ as contract

    from vitrine.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, queries[name], oracles[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s"
              + (f"\n     {problem}" if problem else ""), flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
