"""Holds a query's rows against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        path = f"{sf_dir}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else "")
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def differences(con, df, sql: str, folder: str) -> tuple[list[str], list[str], int, dict]:
    """(columns of df, columns of the SQL, rows that only one side has, columns whose types differ)."""
    df.write.mode("overwrite").parquet(folder)
    con.execute(f"CREATE OR REPLACE TEMP TABLE expected AS {sql}")
    con.execute(f"CREATE OR REPLACE TEMP TABLE found AS SELECT * FROM '{folder}/*.parquet'")
    kinds = [{r[0]: r[1] for r in con.execute(f"DESCRIBE {x}").fetchall()} for x in ("found", "expected")]
    if set(kinds[0]) != set(kinds[1]):
        return sorted(kinds[0]), sorted(kinds[1]), -1, {}
    c = ", ".join(f'"{x}"' for x in sorted(kinds[0]))
    n = con.execute(f"SELECT count(*) FROM ((SELECT {c} FROM expected EXCEPT ALL SELECT {c} FROM found) UNION ALL (SELECT {c} FROM found EXCEPT ALL SELECT {c} FROM expected))").fetchone()[0]
    return sorted(kinds[0]), sorted(kinds[1]), n, {k: (v, kinds[1][k]) for k, v in kinds[0].items() if v != kinds[1][k]}
