"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def ordered(columns, rows):
    names = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in names) for row in rows]
    return [columns[i] for i in names], sorted(table, key=repr)


def oracle_rows(sql: str, sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    return ordered(columns, cursor.fetchall())


def difference(spark, query, sql: str, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    columns, rows = ordered(df.columns, df.collect())
    want_columns, want = oracle_rows(sql, sf_dir)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b or list(map(type, a)) != list(map(type, b))]
    if bad:
        a, b = bad[0]
        return f"{len(bad)} of {len(rows)} rows differ, first:\n   spark {a}\n  oracle {b}"[:3000]
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir, *names = sys.argv[1:]
    spark = session()
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            problem = difference(spark, query, sqls[name], sf_dir) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
