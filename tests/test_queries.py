"""Every registered query against its SQL twin on the smallest tables."""

import re

import __spark_entry__ as entry_module
import pytest
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# Model fits and what a text operator does beyond SQL; tested against numpy or plain Python instead.
WITHOUT_TWIN = {"forecast_autoregressive", "forecast_trend_seasonal", "forecast_forest"}
TEXT_OPERATORS = re.compile(r"op\d+_|pipeline$")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", [q for q in entry_module.queries() if not TEXT_OPERATORS.match(q)])
def test_query(spark, con, name):
    status, note = compare(spark, con, name, SF_DIR)
    assert status == "ok" or (status == "rows" and name in WITHOUT_TWIN), f"{status}: {note}"


def test_oracle_keys_are_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
