"""Run registered queries on Spark and their SQL on DuckDB and compare the results, order aside.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# DuckDB type names that may stand for a Spark type.
KINDS = {
    "bigint": {"BIGINT", "NUMBER"},
    "double": {"DOUBLE", "NUMBER"},
    "int": {"INTEGER", "NUMBER"},
    "string": {"VARCHAR", "STRING"},
    "boolean": {"BOOLEAN", "BOOL"},
    "timestamp_ntz": {"TIMESTAMP", "DATETIME"},
    "timestamp": {"TIMESTAMP", "DATETIME"},
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return v.item() if hasattr(v, "item") else v

    return sorted((tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False)), key=repr)


def compare(spark_df, sql: str, con) -> str | None:
    """None when equal, else what differs."""
    left = pd.DataFrame([tuple(r) for r in spark_df.collect()], columns=spark_df.columns)
    result = con.execute(sql)
    right = pd.DataFrame(result.fetchall(), columns=[d[0] for d in result.description])
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    theirs = {d[0]: str(d[1]).upper() for d in result.description}
    for name, kind in spark_df.dtypes:
        if theirs[name] not in KINDS[kind]:
            return f"type of {name}: {kind} / {theirs[name]}"
    a, b = _normal(left), _normal(right)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


def main() -> int:
    import __spark_entry__ as entry
    from loadloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            if name in oracles:
                verdict = compare(df, oracles[name], con) or "ok"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad = verdict != "ok" and not verdict.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'pass'} {name:32s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
