"""Run every registered query and its SQL on one scale and compare all rows.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark, con, query, sql, folder) -> list[str]:
    df = query(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} / {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows {len(ours[1])} / {len(theirs[1])}"]
    return [f"{a} / {b}" for a, b in zip(ours[1], theirs[1], strict=True) if a != b]


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from daybook.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sys.argv[1])
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            found = differences(spark, con, query, oracle_sql()[name], folder)
        except Exception as error:  # report and go on with the other queries
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {time.time() - started:6.2f}s {name}", flush=True)
        for line in found[:3]:
            print("     ", line[:600])
        if found:
            print("     ", len(found), "differences")
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
