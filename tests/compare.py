"""Side-by-side comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> the DuckDB types that hold the same values.
SAME_TYPE = {
    "string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "smallint": {"SMALLINT"},
    "tinyint": {"TINYINT"}, "double": {"DOUBLE"}, "float": {"FLOAT"}, "boolean": {"BOOLEAN"},
    "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # -0.0 and 0.0 are the same
    return value


def _sortable(row):
    return tuple((v is None, type(v).__name__ if v is None else "", str(v) if isinstance(v, (bool, str)) else repr(v)) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    result = con.execute(sql)
    their_types = {d[0]: str(d[1]) for d in result.description}
    their_rows = result.fetchall()
    their_names = [d[0] for d in result.description]
    names = sorted(df.columns)
    if names != sorted(their_names):
        return [f"columns {names} against {sorted(their_names)}"]
    found = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if their_types[f.name] not in SAME_TYPE.get(kind, set()):
            found.append(f"type of {f.name}: {kind} against {their_types[f.name]}")
    ours = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_sortable)
    order = [their_names.index(n) for n in names]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in their_rows), key=_sortable)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    elif ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
