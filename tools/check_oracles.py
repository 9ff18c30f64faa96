"""Run registered queries and their SQL checks side by side.

    python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caseflow.plans.queries import ORACLES, QUERIES  # noqa: E402
from caseflow.session import local_session  # noqa: E402


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in value order, numbers as floats."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype(float)
        else:
            df[c] = df[c].map(lambda v: "<null>" if v is None or v is pd.NA or v != v else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None where both hold the same rows; otherwise what differs first."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    a, b = canonical(left), canonical(right)
    for c in a.columns:
        bad = (a[c] != b[c]) & ~(a[c].isna() & b[c].isna())
        if bad.any():
            at = bad.idxmax()
            return f"{int(bad.sum())} rows differ in {c}: {a.loc[at].to_dict()} vs {b.loc[at].to_dict()}"
    return None


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    spark = local_session(__import__("os").environ.get("CHECK_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            problem = differences(found, con.execute(ORACLES[name]).df()) if name in ORACLES else None
            mark = "rows " if name not in ORACLES else "ok   "
        except Exception as error:  # noqa: BLE001
            problem, took, found = f"{type(error).__name__}: {str(error)[:900]}", time.time() - start, []
        failed += problem is not None
        print(f"{'FAIL ' if problem else mark} {name:28s} {len(found):7d} rows {took:6.2f}s  {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
