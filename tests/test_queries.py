"""Registered queries against their SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks import compare
from checks.oracle import ORACLES
from checks.registry import QUERIES

SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}
# Too few users for these fits to be meaningful at the small scale; covered by their own tests.
FITS = {"mlp_predictions", "ensemble_predictions", "trained_metrics", "cluster_assignments", "cluster_metadata"}
# Compared on more users.
LARGER = {"vote_audit", "svm_audit", "svm_predictions", "cluster_audit", "pca_variance", "repeatable_assignments", "repeatable_metadata"}


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) - set(ORACLES) == FITS
    assert contract.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(LARGER))
def test_fit_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, folder)
    ours = compare.table_of(df.columns, [tuple(r) for r in df.collect()])
    assert compare.difference(ours, compare.from_sql(compare.connect(folder), name)) is None


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LARGER))
def test_query_equals_sql(spark, con, small, name):
    df = QUERIES[name](spark, small)
    ours = compare.table_of(df.columns, [tuple(r) for r in df.collect()])
    assert compare.difference(ours, compare.from_sql(con, name)) is None
    kinds = {row[0]: row[1] for row in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == kinds


@pytest.mark.parametrize("name", sorted(FITS))
def test_fit_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_sql_needs_no_session():
    assert all(isinstance(sql, str) and duckdb.extract_statements(sql) for sql in ORACLES.values())
