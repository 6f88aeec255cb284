"""Compare Spark rows with the rows of the check SQL, exactly and in any order."""

from __future__ import annotations

import duckdb

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal_value(value):
    if isinstance(value, float) and value == 0.0:
        return 0.0
    if isinstance(value, list):
        return tuple(normal_value(v) for v in value)
    return value


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal_value(r[i]) for i in order) for r in rows), key=repr)


def compare(con, sql: str, columns: list[str], rows: list[tuple]) -> str:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(columns):
        return f"columns {sorted(columns)} != {sorted(names)}"
    expected = normal_rows(names, result.fetchall())
    if len(expected) != len(rows):
        return f"{len(rows)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b or repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} rows differ, first: {str(wrong[0][0])[:300]} expected {str(wrong[0][1])[:300]}"
    return "ok"
