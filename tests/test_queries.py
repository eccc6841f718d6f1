"""Every registered query beside its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as entry
from workload import registry
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = registry.QUERIES, registry.CHECKS


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "program_id", "type", "subscale", "barriers", "neutral", "facilitators"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    assert compare(spark, con, SF, QUERIES[key], CHECKS.get(key)) == ""


@pytest.mark.parametrize("key", ["sort_multi_key", "sort_custom_order"])
def test_order_of_sorted_results(spark, con, key):
    """Rows in the very order the SQL gives."""
    got = QUERIES[key](spark, SF)
    sql = CHECKS[key] + ("" if "ORDER BY" in CHECKS[key] else " ORDER BY position, program_id, date")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert [tuple(r) for r in got.select(*names).collect()] == cur.fetchall()
