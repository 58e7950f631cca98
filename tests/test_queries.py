from __future__ import annotations

import pytest
from oracle import assert_same

import __spark_entry__ as entry
from brindle.plans import roundtrips  # noqa: F401  registers its queries
from brindle.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
