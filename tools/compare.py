"""Run registered queries against their SQL in DuckDB and report differences.

Usage: python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stormledger import catalog, session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """A value in a form that compares across both engines."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Type names of the two engines that mean the same.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_difference(out, con, sql: str) -> str | None:
    """Columns whose types differ between both engines."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    have = {n: SAME_TYPE.get(t, t) for n, t in out.dtypes}
    bad = {n: (have[n], want.get(n)) for n in have if have[n] != want.get(n)}
    return f"types differ: {bad}" if bad else None


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    out = catalog.QUERIES[name](spark, sf_dir)
    got = rows_of(out.columns, [tuple(r) for r in out.collect()])
    if name not in catalog.SQL:
        return None if got else "no rows"
    cur = con.execute(catalog.SQL[name])
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(out.columns):
        return f"columns {sorted(out.columns)} != {sorted(columns)}"
    if problem := type_difference(out, con, catalog.SQL[name]):
        return problem
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        session.builder("compare").master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in args or catalog.QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        kind = "sql" if name in catalog.SQL else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.2f}s {kind:4} {name} {problem or ''}", flush=True)
    print(f"{failed} failed of {len(args or catalog.QUERIES)}")


if __name__ == "__main__":
    main()
