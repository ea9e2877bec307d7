"""Row comparison between a Spark frame and a DuckDB query."""

from pathlib import Path

import duckdb


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as readable lines; empty when the results are equal."""
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    other = _sorted_rows(names, got.fetchall())
    if not mine:
        return ["no rows"]
    if mine == other:
        return []
    out = [f"{len(mine)} rows against {len(other)}"]
    types = [(repr(a), repr(b)) for a, b in zip(mine, other) if a != b]
    return out + [f"{a[:300]}\n  {b[:300]}" for a, b in types[:3]]
