"""Compare a Spark result with its SQL twin: names, types by kind, rows as a bag."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "int",
    "long": "int", "short": "int", "hugeint": "int", "double": "float", "float": "float",
    "varchar": "text", "string": "text", "boolean": "bool", "date": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def _bag(rows, order):
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    theirs = db.execute(sql)
    names = [c[0] for c in theirs.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = dict(df.dtypes)
    described = {r[0]: r[1].lower() for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    problems = [
        f"type of {n}: {types[n]} != {described[n]}"
        for n in names
        if KINDS.get(types[n], types[n]) != KINDS.get(described[n], described[n])
    ]
    ordered = sorted(names)
    mine = _bag(df.collect(), [df.columns.index(n) for n in ordered])
    other = _bag(db.execute(sql).fetchall(), [names.index(n) for n in ordered])
    if mine != other:
        extra, lacking = mine - other, other - mine
        problems.append(
            f"rows {sum(mine.values())} != {sum(other.values())}; columns {ordered}; "
            f"extra {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"
        )
    return problems
