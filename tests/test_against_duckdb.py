"""Every registered query against DuckDB on the smallest given tables."""

from __future__ import annotations

import pytest

from checks.compare import differences, duck
from checks.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLES
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], con) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 1
