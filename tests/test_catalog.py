"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from catalog.oracles import oracles
from catalog.queries import QUERIES
from conftest import SF_DIR
from oracle_compare import compare, connect

SQL = oracles()
TRAINED = {
    "model_comparison", "best_model", "ridge_coefficients", "feature_importance", "test_metrics", "predictions",
    "residual_diagnostics", "residual_histogram", "registry_snapshot", "grown_forest_metrics", "grown_forest_importance",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    good, text = compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert good, text


def test_queries_without_sql_are_known():
    assert set(QUERIES) - set(SQL) == TRAINED
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_names_are_plain():
    assert all(re.fullmatch(r"[a-z][a-z_0-9]*", name) for name in QUERIES)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() == 6 and rows.columns[0] == "variable"
