"""Corpus queries against their check SQL on the sf0.01 tables."""

import compare
import pytest

from dockside.llm.queries import QUERIES
from dockside.llm.sql import CHECKS


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(name, spark, sf_dir):
    con = compare.connect(sf_dir)
    assert compare.differences(QUERIES[name](spark, sf_dir), con, CHECKS[name]) == []
