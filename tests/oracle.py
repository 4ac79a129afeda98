"""Compare registered queries with their SQL in DuckDB.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    """A sortable form that keeps values and their kinds apart."""
    if v is None:
        return ("null", "")
    if isinstance(v, bool):
        return ("bool", str(v))
    if isinstance(v, int):
        return ("int", f"{v:d}")
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else f"{v + 0.0:.10g}")
    if isinstance(v, datetime.datetime):
        return ("time", v.isoformat())
    if isinstance(v, datetime.date):
        return ("date", v.isoformat())
    return (type(v).__name__, str(v))


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, run, sql: str) -> list[str]:
    """What differs between the Spark rows and the SQL rows; empty when they agree."""
    df = run(spark, sf_dir)
    s_cols, s_rows = _normal(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    o_cols, o_rows = _normal(list(rel.columns), rel.fetchall())
    if s_cols != o_cols:
        return [f"columns: only spark {set(s_cols) - set(o_cols)}, only sql {set(o_cols) - set(s_cols)}"]
    found = []
    if len(s_rows) != len(o_rows):
        found.append(f"rows: spark {len(s_rows)}, sql {len(o_rows)}")
    if s_rows != o_rows:
        for a, b in zip(s_rows, o_rows):
            if a != b:
                found += [f"{c}: spark {x} sql {y}" for c, x, y in zip(s_cols, a, b) if x != y][:4]
                break
        found.append(f"{len(set(s_rows) ^ set(o_rows))} rows differ")
    return found


def main() -> int:
    from tallyloom.session import build_session

    sys.path.insert(0, os.getcwd())
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__warehouse__dir="/tmp/tallyloom-warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, sf_dir, run, sqls[name])
            else:
                found = [] if run(spark, sf_dir).count() else ["no rows"]
        except Exception as err:  # report and go on with the next query
            found = [f"{type(err).__name__}: {str(err)[:700]}"]
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok ' if not found else 'BAD'} {kind} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
        bad += bool(found)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
