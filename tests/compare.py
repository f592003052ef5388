"""Runs a query in Spark and its check SQL in DuckDB and compares rows as multisets."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_KINDS = {
    "bigint": "int", "int": "int", "double": "double", "string": "text", "boolean": "bool", "date": "date",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in found.description}
    spark_kinds = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if kinds != spark_kinds:
        return f"columns: spark {sorted(spark_kinds.items())} duckdb {sorted(kinds.items())}"
    expected = _rows(found.fetchall(), names)
    actual = _rows(df.collect(), df.columns)
    if not expected:
        return "no rows"
    if actual != expected:
        extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
        return f"rows: spark {sum(actual.values())} duckdb {sum(expected.values())} extra {extra} missing {missing}"
    return None


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from assocspark import new_session

    spark, con = new_session(8), database(folder)
    queries, oracle, bad = entry.queries(), entry.oracle_sql(), 0
    for name in only or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = difference(df, con, oracle[name]) if name in oracle else (None if df.collect() else "no rows")
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1200]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name:28s} {'ok' if problem is None else 'DIFFERS ' + problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
