"""Every registered query against its SQL, all rows."""

import pytest

import __spark_entry__ as driver
from retail_checks.catalog import QUERIES
from retail_checks.compare import differences
from retail_checks.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, key):
    assert differences(QUERIES[key](spark, SF), ORACLE[key], SF) == []


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


def test_entry_has_the_published_columns(spark):
    from aisleworks.schemas import KPI_COLUMNS

    df = driver.entry(spark)
    assert tuple(df.columns) == KPI_COLUMNS
    assert df.count() > 0


def test_fact_fixtures_hold_the_documented_rows(spark):
    from retail_checks import derived

    assert derived.sales(spark, SF).count() == 6000
    assert derived.inventory(spark, SF).count() == 5327
