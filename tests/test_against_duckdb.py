"""Every registered query on the smallest tables against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from fleetlens import catalog, oracle
from tests.conftest import SMALL
from tools.check import compare, connect

# The training-data operators have tests of their own.
QUERIES = {name: entry.queries()[name] for name in catalog.QUERIES}
ORACLES = oracle.ORACLES


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_query(spark, db, name):
    assert compare(spark, db, SMALL, name, QUERIES[name], ORACLES[name]).startswith("ok")


@pytest.mark.parametrize("name", ["stream_active_vehicles", "stream_speed_by_line", "stream_vehicle_status"])
def test_continuous_job(spark, db, name):
    assert compare(spark, db, SMALL, name, QUERIES[name], ORACLES[name]).startswith("ok")


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
