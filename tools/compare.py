"""Compare registered queries with their SQL on DuckDB: columns, row counts, values.

    python tools/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from rankloom.plans.oracle import ORACLE  # noqa: E402
from rankloom.plans.queries import QUERIES  # noqa: E402
from rankloom.session import local_session  # noqa: E402
from rankloom.sources.tables import TABLES  # noqa: E402


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, bool):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return columns, types, result.fetchall()


def compare(spark, folder: str, name: str) -> str:
    started = time.time()
    df = QUERIES[name](spark, folder)
    spark_rows = df.collect()
    took = time.time() - started
    if name not in ORACLE:
        return f"rows-only rows={len(spark_rows)} {took:.1f}s"
    columns, types, rows = oracle_rows(folder, ORACLE[name])
    if sorted(columns) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} != {sorted(columns)}"
    ours, theirs = rows_of(df.columns, spark_rows), rows_of(columns, rows)
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        return f"MISMATCH rows {len(ours)} vs {len(theirs)}\n   cols  {sorted(columns)}\n   spark {only_ours}\n   sql   {only_theirs}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
    spark_types = dict(df.dtypes)
    differing = [f"{c}:{spark_types[c]}/{t}" for c, t in zip(columns, types) if kinds.get(t, t) != spark_types[c]]
    note = f" types {differing}" if differing else ""
    return f"ok rows={len(ours)} {took:.1f}s{note}"


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            outcome = compare(spark, folder, name)
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += outcome.startswith(("MISMATCH", "ERROR"))
        print(f"{name}: {outcome}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
