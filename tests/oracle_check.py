"""Run every registered query against its SQL in DuckDB.

python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if rows, columns, types and values agree, else what differs."""
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    result = con.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    kinds = {d[0]: str(d[1]).upper() for d in result.description}
    expected_kinds = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    for column, kind in df.dtypes:
        if expected_kinds.get(kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in result.fetchall()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    a, b = sorted(ours, key=repr), sorted(theirs, key=repr)
    for left, right in zip(a, b):
        if left != right:
            return f"first difference: {left} != {right}"
    return None


def main() -> int:
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(driver.queries())
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        if name not in driver.oracle_sql():
            verdict = f"rows only: {driver.queries()[name](spark, sf_dir).count()}"
        else:
            try:
                problem = compare(spark, con, name, sf_dir)
            except Exception as error:  # report and go on to the next query
                problem = f"{type(error).__name__}: {str(error)[:600]}"
            failed += problem is not None
            verdict = problem or "ok"
        print(f"{name:34s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
