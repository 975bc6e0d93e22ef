"""Compare every registered query with its SQL at a scale: ``python -m checks.compare [sf_dir] [name ...]``."""

import math
import sys
import time

import duckdb

from checks.oracle import ORACLES
from checks.registry import QUERIES
from clickloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.5f}"
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def from_spark(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def from_sql(con, name):
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    return table_of(columns, result.fetchall())


def difference(ours, theirs) -> str | None:
    """First difference of two tables, or None."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a}\n   / {b}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        ours = from_spark(spark, name, sf_dir)
        found = difference(ours, from_sql(con, name)) if name in ORACLES else None
        failed += found is not None
        verdict = "DIFFERS " + found if found else ("equal" if name in ORACLES else "rows only")
        print(f"{name:26s} {len(ours[1]):7d} rows {time.time() - start:6.2f} s  {verdict}", flush=True)
    print("unknown oracle keys:", sorted(set(ORACLES) - set(QUERIES)), "failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
