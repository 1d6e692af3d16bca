"""Run registered queries and their SQL side by side.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(folder):
    import duckdb

    from rowferry.plans.tables import NAMES

    db = duckdb.connect()
    for name in NAMES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return str(decimal.Decimal(value).normalize())
    if isinstance(value, float):
        return "nan" if math.isnan(value) else format(value, ".10g")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(repr(plain(row[i])) for i in order) for row in rows
    )


def compare(spark, db, name, query, sql, folder):
    """(rows, None if equal, else what differs)."""
    df = query(spark, folder)
    names, rows = canonical(df.columns, df.collect())
    result = db.execute(sql)
    other_names = [c[0] for c in result.description]
    other_names, other = canonical(other_names, result.fetchall())
    if names != other_names:
        return len(rows), f"columns {names} against {other_names}"
    if len(rows) != len(other):
        return len(rows), f"{len(rows)} rows against {len(other)}"
    for a, b in zip(rows, other):
        if a != b:
            return len(rows), f"{str(a)[:300]}\n   against {str(b)[:300]}"
    return len(rows), None


def main():
    from __spark_entry__ import oracle_sql, queries
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark, db = make_session(), duck(folder)
    all_sql, bad = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            n, found = compare(spark, db, name, query, all_sql[name], folder)
        except Exception as error:
            n, found = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'BAD '} {name} {n} rows {time.time() - started:.1f}s"
              + (f"\n   {found}" if found else ""), flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
