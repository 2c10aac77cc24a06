"""Run registered queries beside their DuckDB SQL and compare every value.

    python tests/check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is not None, v) for v in row))


def _equal(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(spark, db, folder: str, name: str) -> str:
    """'' if the query gives what its SQL gives, else the first difference."""
    df = registered.queries()[name](spark, folder)
    rows = _normal([tuple(r) for r in df.collect()], df.columns)
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return "" if rows else "no rows"
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    types = {c[0]: SPARK_TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if types != dict(df.dtypes):
        return f"types {dict(df.dtypes)} != {types}"
    expected = _normal(result.fetchall(), columns)
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for got, want in zip(rows, expected):
        if not all(map(_equal, got, want)):
            return f"{str(got)[:400]} != {str(want)[:400]}"
    return ""


def main() -> int:
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(registered.queries())
    spark, db, failures = make_session(), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(), 1))
