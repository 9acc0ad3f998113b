"""Every query with SQL gives DuckDB's rows; the others run and give rows."""

import os

import pytest

from chemprobe.plans import catalogue
from tests.parity import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_parity(spark, name):
    compare(spark, SF, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 7
