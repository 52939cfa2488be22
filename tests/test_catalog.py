"""Every query against its check SQL on the sf0.01 tables."""

import __spark_entry__ as entry
import compare
import pytest

from dockside import operators as ops
from dockside.catalog import QUERIES
from dockside.check_sql import CHECKS


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_every_report_is_registered():
    numbers = {name.split("_")[0].rstrip("n") for name in QUERIES}
    assert {f"r{i:02d}" for i in range(1, 86)} <= numbers


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(name, spark, sf_dir, con):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, CHECKS[name]) == []


def test_sample_does_not_depend_on_partitioning(spark, sf_dir):
    table = QUERIES["r05_sot_brand_category"](spark, sf_dir)
    keys = ("ShipCancelMonth", "ReportingBrand", "Category")
    one, many = (ops.peek(table.repartition(n), keys, 10, seed=3).collect() for n in (1, 13))
    assert one == many and set(map(tuple, one)) <= set(map(tuple, table.collect()))


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
