"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if v is None:
        return "~"
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types and rows agree, else the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours_kinds = {n: KINDS.get(t, t.upper()) for n, t in spark_df.dtypes}
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
            return f"row differs: {bad[:4]}"
    wrong = {n: (t, kinds[n]) for n, t in ours_kinds.items() if t != kinds[n].replace(" ", "")}
    if wrong:
        return f"types {wrong}"
    return None
