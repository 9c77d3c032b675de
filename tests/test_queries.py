"""Every registered query against its SQL on the same tables."""

import pytest

from tests.compare import compare
from tidemark.queries.registry import ORACLE, QUERIES, load_all

load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    ok, note = compare(QUERIES[name](spark, sf_dir), ORACLE[name], duck)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
