"""Every named query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from assetlake.plans.registry import ORACLES, QUERIES
from compare import duck, duck_table, spark_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_table(entry.queries()[name](spark, SF_DIR))
    assert got == duck_table(con, entry.oracle_sql()[name])


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["position", "rule", "args", "passed", "violations", "detail", "dataset"]
    assert report.count() == 8
