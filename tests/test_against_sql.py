"""Every query with SQL must give the same rows in both engines."""

import pytest
import verify

import __spark_entry__ as entry

QUERIES, SQLS = entry.queries(), entry.oracle_sql()
# checked at a larger scale by tools/verify.py; too slow to repeat here
SLOW = {"g10_nearest_neighbours", "k1_cross_validation", "a11_grid_trace", "k5_k6_grid_summary", "l2_odds_ratios"}
FAST = sorted(n for n in SQLS if n not in SLOW)


@pytest.fixture(scope="session")
def duck(sf):
    return verify.connect(sf)


@pytest.mark.parametrize("name", FAST)
def test_same_rows(spark, duck, sf, name):
    status, _ = verify.compare(spark, duck, QUERIES[name], SQLS[name], sf)
    assert status == "ok"


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1
