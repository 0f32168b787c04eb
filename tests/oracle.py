"""Compare query results with the SQL oracle, value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted_rows(rows):
    return sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def differences(df, con, sql) -> str | None:
    """None if the DataFrame and the SQL give the same rows, else what differs."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} and {sorted(relation.columns)}"
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = _sorted_rows(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    got = _sorted_rows([tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()])
    if got == expected:
        return None
    only_got = [r for r in got[:200000] if r not in set(expected)][:3]
    only_expected = [r for r in expected if r not in set(got)][:3]
    return f"{len(got)} rows, {len(expected)} expected; {only_got} / {only_expected}"
