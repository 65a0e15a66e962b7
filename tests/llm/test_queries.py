"""Every query with SQL gives the SQL's rows."""

import pytest

from bulwark.llm.queries import QUERIES, SQL
from tools.check import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    assert compare(QUERIES[name](spark, sf), duck, SQL[name]) == ""
