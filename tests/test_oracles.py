"""Every query with SQL gives the SQL's rows on the smallest tables."""

import pytest

import __spark_entry__ as entry
from bulwark.queries import REGISTRY
from tools.check import compare

SQL = {name: q.sql for name, q in REGISTRY.items() if q.sql}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    assert compare(REGISTRY[name].run(spark, sf), duck, SQL[name]) == ""


def test_entry_has_rows_and_stable_schema(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() == 3


def test_no_query_is_named_like_a_step():
    assert not [n for n in REGISTRY if "pipeline" in n or n.startswith("op")]
