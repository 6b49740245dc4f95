"""Run registered queries in Spark and in DuckDB on the same files and compare the results.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value) if value != value.to_integral_value() else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def normalised(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain_rows = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain_rows, key=repr)


def compare(spark, con, folder: str, query, sql: str | None) -> tuple[bool, str]:
    begun = time.time()
    result = query(spark, folder)
    columns, rows = normalised(result.columns, result.collect())
    spent = time.time() - begun
    if sql is None:
        return True, f"rows only: {len(rows)} rows, {spent:.1f} s"
    cursor = con.execute(sql)
    want_columns, want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}"
    if rows != want:
        differing = [(a, b) for a, b in zip(rows, want) if a != b][:2]
        return False, f"{len(rows)} rows against {len(want)}; first differences: {str(differing)[:1500]}"
    return True, f"{len(rows)} rows, spark {spent:.1f} s, sql {time.time() - begun - spent:.1f} s"


def main() -> int:
    from corpusloom.queries import registry
    from corpusloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, failed = local_session(cores="8"), connect(folder), []
    for name, (query, sql) in registry().items():
        if wanted and name not in wanted:
            continue
        try:
            ok, note = compare(spark, con, folder, query, sql)
        except Exception as failure:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(failure).__name__}: {str(failure)[:900]}"
        print("ok  " if ok else "FAIL", name, "-", note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
