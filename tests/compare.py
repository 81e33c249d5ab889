"""Compare a query with its SQL: column names, row counts, and values as multisets."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
KINDS = {"tinyint": "int", "smallint": "int", "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime, date)):
        return value.replace(tzinfo=None) if isinstance(value, datetime) else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return (type(value).__name__, value)


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, con) -> list[str]:
    """What differs; empty if nothing does."""
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_types = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in cursor.description}
    sql_rows = cursor.fetchall()
    names = df.columns
    types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    rows = [tuple(r) for r in df.collect()]
    found = []
    if sorted(names) != sorted(sql_names):
        return [f"columns {sorted(names)} / {sorted(sql_names)}"]
    if types != sql_types:
        found.append(f"types {types} / {sql_types}")
    if len(rows) != len(sql_rows):
        found.append(f"rows {len(rows)} / {len(sql_rows)}")
    mine, theirs = _bag(names, rows), _bag(sql_names, sql_rows)
    if mine != theirs:
        found.append(f"only here {list((mine - theirs).items())[:3]}; only in SQL {list((theirs - mine).items())[:3]}")
    return found
