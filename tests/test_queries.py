from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import differences
from checks.queries import QUERIES

SLOW = {"star_load", "daily_run", "incremental_load"}


def test_contract(spark):
    assert contract.queries().keys() >= contract.oracle_sql().keys()
    assert contract.entry(spark).columns == ["month", "topic", "article_count", "rank"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_equals_its_sql(spark, name):
    assert differences(spark, "/root/testdata/sf0.001", name) is None
