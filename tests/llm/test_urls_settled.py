"""Ranks settle, however long the ways are."""

from bulwark.llm import urls
from tests.llm.test_urls import judged


def test_a_chain_longer_than_the_rounds_of_the_query(spark):
    n = 12
    rows = [(i, f"http://h{i}.org/", f'<a href="http://h{i + 1}.org/">x</a>') for i in range(n)] + [(n, "http://bad.com/", ""), (n + 1, f"http://h{n}.org/", '<a href="http://bad.com/">x</a>')]
    got = judged(spark, rows, [("allow", "good.com", "/"), ("block", "bad.com", "/")])
    assert {r["verdict"] for r in got.values()} == {"block"}
    ranks = [got[i]["distrust"] for i in [*range(n), n + 1, n]]
    assert all(0 < a < b for a, b in zip(ranks, ranks[1:]))


def test_settled_ranks_by_hand(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", "trust", 2)], "host string, kind string, n long")
    got = {r["host"]: r["rank"] for r in urls.propagate(edges, seeds).collect()}
    a = urls.MASS * 0.15 / (1 - 0.85**2)
    left = 10 * urls.SETTLED
    assert abs(got["a"] - a) < left and abs(got["b"] - 0.85 * a) < left
    assert urls.propagate(edges, seeds.limit(0)).count() == 0
