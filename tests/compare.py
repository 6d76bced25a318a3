"""Run registered queries and their SQL equivalents side by side.

``python tests/compare.py <sf_dir> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    spill = tempfile.mkdtemp(prefix="oracle-spill-")
    con = duckdb.connect(config={"temp_directory": spill, "max_temp_directory_size": "4GB"})
    for table in TABLES.split():
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row):
    return [(v is not None, str(v)) for v in row]


def mismatch(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a statement, or None. Values must be equal, not close."""
    cols = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} != {sorted(rel.columns)}"
    ours = sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)
    theirs = sorted(rel.select(*[f'"{c}"' for c in cols]).fetchall(), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        )
        if not same:
            return f"{a} != {b}"
        if any(type(x) is not type(y) for x, y in zip(a, b)):
            return f"types of {a} and {b}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from kinweave.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con, sqls = local_session(8), connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:28s} no oracle")
            continue
        t = time.time()
        try:
            problem = mismatch(fn(spark, sf_dir), con, sqls[name])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - t:6.2f}s {problem or 'equal'}", flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
