"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tidewater.plans import catalogue
from tests.conftest import SMALL
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    own = set(catalogue.load())
    assert own <= set(driver.queries()) and own <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.load()))
def test_query(spark, duck, name):
    assert differences(driver.queries()[name](spark, SMALL), duck, driver.oracle_sql()[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).columns == ["event_type", "window_start", "window_end", "pv", "line"]
