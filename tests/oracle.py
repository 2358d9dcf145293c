"""Runs registered queries next to their SQL and compares the rows.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, query, sql: str) -> str | None:
    """None if both sides give the same rows, else what differs."""
    df = query(spark, folder)
    mine = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from attriflux.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con, sqls = local_session(), connect(folder), oracle_sql()
    for name in wanted:
        start = time.time()
        try:
            if name in sqls:
                outcome = difference(spark, con, folder, queries()[name], sqls[name]) or "same"
            else:
                outcome = f"{len(queries()[name](spark, folder).collect())} rows, no SQL"
        except Exception as exc:
            outcome = f"ERROR {type(exc).__name__} {str(exc)[:700]}"
        print(f"{name:34s} {time.time() - start:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
