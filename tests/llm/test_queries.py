import math

import duckdb
import pytest

from clickloom.llm.oracle import ORACLES
from clickloom.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return round(value, 4) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_as_sql(spark, small, name):
    rows = QUERIES[name](spark, small)
    columns = sorted(rows.columns)
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    found = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(map(plain, r)) for r in rows.select(*columns).collect()]
    assert sorted(map(str, got)) == sorted(str(tuple(map(plain, r))) for r in found)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].partition("_")[0]) for n in QUERIES) == list(range(1, 14))
