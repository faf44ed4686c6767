"""Every registered query against its SQL."""

import pytest

from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.queries import all_queries

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, sf, name):
    verdict, n, _ = compare(spark, con, sf, name)
    assert verdict.startswith("ok"), verdict
    assert n > 0


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).columns == [
        "seq", "station_id", "num_bikes_available", "capacity", "ratio"]
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())
