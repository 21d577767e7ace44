"""Compare a gallery run with its SQL in DuckDB, values and types included."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPE_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    found = []
    rel = con.sql(sql)
    ours = dict(zip(df.columns, (f.dataType.simpleString() for f in df.schema.fields)))
    theirs = dict(zip(rel.columns, (str(t) for t in rel.types)))
    if sorted(ours) != sorted(theirs):
        return [f"columns differ: {sorted(set(ours) ^ set(theirs))}"]
    for name, kind in ours.items():
        got = theirs[name].replace("JSON", "VARCHAR")
        if TYPE_NAMES.get(kind, kind) != got:
            found.append(f"type of {name}: {kind} against {got}")
    mine = sorted_rows(df.columns, df.collect())
    other = sorted_rows(rel.columns, rel.fetchall())
    if len(mine) != len(other):
        found.append(f"row counts: {len(mine)} against {len(other)}")
    elif mine != other:
        bad = [(a, b) for a, b in zip(mine, other) if a != b]
        found.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return found
