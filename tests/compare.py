"""Compares registered queries with their SQL on the same tables.

python -m tests.compare <folder> [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def value(v):
    """One form per kind of value; the kind itself counts."""
    if v is None:
        return None
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("float", v)
    if isinstance(v, datetime.datetime):
        return ("time", v.isoformat())
    if isinstance(v, datetime.date):
        return ("date", v.isoformat())
    return (type(v).__name__, str(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in data)


def difference(spark, con, query, sql, folder) -> str | None:
    """None when both sides agree, else a short description."""
    df = query(spark, folder)
    ours = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    theirs = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} <> {sorted(rel.columns)}"
    if not ours:
        return "no rows"
    a, b = rows(df.columns, ours), rows(rel.columns, theirs)
    if a == b:
        return None
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return f"{len(ours)} rows <> {len(theirs)}; only ours {len(only_a)}: {only_a[:2]}; only SQL {len(only_b)}: {only_b[:2]}"


def main() -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from ledgerflow.settings import session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, known, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            if name in known:
                found = difference(spark, con, query, known[name], folder)
            else:
                found = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - began:.1f}s {'' if name in known else '(rows only)'} {found or ''}", flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
