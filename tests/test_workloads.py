"""Every registered query against its SQL, on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as spark_entry
from workloads.compare import difference, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OPTIONAL = re.compile(r"op\d+_|pipeline$")  # tested in tests/llm
QUERIES = {k: v for k, v in spark_entry.queries().items() if not OPTIONAL.match(k)}
ORACLES = {k: v for k, v in spark_entry.oracle_sql().items() if not OPTIONAL.match(k)}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_registry():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 90
    assert set(QUERIES) - set(ORACLES) == {"simplified_coverage"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    assert found
    if name in ORACLES:
        expected_columns, expected = oracle_rows(SF_DIR, ORACLES[name])
        assert columns == expected_columns
        assert difference(found, expected) is None


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
