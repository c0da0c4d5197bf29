import pytest
from oracle import connect, differences

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    assert differences(driver.queries()[name](spark, FOLDER), db, driver.oracle_sql()[name]) == []


def test_entry_has_one_row_per_well_and_day(spark):
    mart = driver.entry(spark)
    assert mart.count() == 397 and len(mart.columns) == 60
