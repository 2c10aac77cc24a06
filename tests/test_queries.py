"""Every registered query against its DuckDB SQL on the smallest tables."""

import check_queries
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", list(check_queries.registered.catalog.queries()))
def test_query(spark, db, name):
    assert check_queries.compare(spark, db, FOLDER, name) == ""


def test_every_query_has_its_sql():
    assert set(check_queries.registered.catalog.queries()) == set(check_queries.registered.expected_sql.statements())
    assert set(check_queries.registered.oracle_sql()) <= set(check_queries.registered.queries())
