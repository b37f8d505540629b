"""Run registered queries next to their SQL and compare rows, types and values.

    python tools/check_queries.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.queries import load_all  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (datetime.date, decimal.Decimal)):
        return str(value)
    return repr(value) if isinstance(value, float) else value


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str:
    columns = sorted(df.columns)
    rows = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != columns:
        return f"columns differ: {columns} vs {sorted(described)}"
    names = ", ".join(f'"{c}"' for c in columns)
    expected = [
        tuple(plain(v) for v in row)
        for row in con.execute(f"SELECT {names} FROM ({sql})").fetchall()
    ]
    notes = []
    for field in df.schema.fields:
        shown = field.dataType.simpleString()
        wanted = TYPES.get(shown, shown.upper())
        if wanted != described[field.name]:
            notes.append(f"{field.name}: {shown} vs {described[field.name]}")
    order = lambda row: tuple((v is None, str(v)) for v in row)
    rows.sort(key=order)
    expected.sort(key=order)
    if len(rows) != len(expected):
        notes.append(f"ROWS {len(rows)} vs {len(expected)}")
    if rows != expected:
        different = [(a, b) for a, b in zip(rows, expected) if a != b][:3]
        notes.append(f"VALUES differ, e.g. {columns}: {different}")
    return "; ".join(notes) or f"ok ({len(rows)} rows)"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--data", default="/root/testdata")
    args = parser.parse_args()
    sf_dir = f"{args.data}/sf{args.sf}"
    spark = build_session("check", "local[8]", 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, registered in load_all().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        started = time.time()
        try:
            df = registered.run(spark, sf_dir)
            verdict = (
                compare(df, con, registered.sql) if registered.sql
                else f"rows only ({df.count()} rows)"
            )
        except Exception as failure:
            verdict = "FAILED " + "".join(traceback.format_exception_only(failure))[:900]
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name}: {verdict} [{time.time() - started:.1f}s]", flush=True)
    print(f"{bad} with problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
