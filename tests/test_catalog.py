"""Every catalogued query against plain SQL in DuckDB, on the smallest driver data."""

import pathlib

import pytest

from catalog.compare import compare, connect
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="driver data not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""
