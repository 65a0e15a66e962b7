from pyspark.sql import functions as F

from bulwark.llm import urls
from bulwark.llm.queries import URL_RULES
from tools.check import compare

ROWS = "page_id long, url string, html string"


def judged(spark, rows, rules=URL_RULES):
    df = spark.createDataFrame([(*r, "x") for r in rows], ROWS + ", host string")
    return {r["page_id"]: r for r in urls.judge(df, rules).collect()}


def test_hosts_paths_and_longest_rule(spark):
    given = {
        1: ("https://a.Example.com/en/x?y", "a.example.com", "/en/x", "example.com/en/", "block"), 2: ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("ftp://x.com", "x.com", "", None, "allow"), 4: ("http://x.com/?a://b", "x.com", "/", "com/", "allow"), 5: ("no scheme", "", "", None, "allow"), 6: (None, "", "", None, "allow"),
        7: ("http://a.net/es/1#f", "a.net", "/es/1", "net/es/", "block"), 8: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), 9: ("x?u=http://b.net/fr/", "b.net", "/fr/", "net/fr/", "block"),
        10: ("http://É.com/ü", "É.com", "/ü", "com/", "allow"), 11: ("://net/fr/", "net", "/fr/", "net/fr/", "block"), 12: ("http://" + "a" * 50_000 + ".com/", "a" * 50_000 + ".com", "/", "com/", "allow"),
    }
    got = judged(spark, [(i, v[0], None) for i, v in given.items()])
    assert {i: tuple(r)[1:5] for i, r in got.items()} == {i: v[1:] for i, v in given.items()}


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rules = [("allow", "good.com", "/"), ("block", "bad.com", "/")]
    link = lambda *hosts: "".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    rows = [(1, "http://good.com/", link("friend.org")), (2, "http://bad.com/", link("good.com")), (3, "http://farm.org/", link("bad.com", "BAD.com")),
            (4, "http://friend.org/", None), (5, "http://island.org/", ""), (6, "http://deep.org/", "<A HREF=//farm.org/x>"), (7, "http://sub.farm.org/", None)]
    got = judged(spark, rows, rules)
    assert {i: r["verdict"] for i, r in got.items()} == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block"}
    assert got[4]["trust"] > 0 == got[4]["distrust"] and got[3]["distrust"] > got[6]["distrust"] > 0


def test_one_round_by_hand(spark):
    edges = spark.createDataFrame([("a", "b", 3), ("a", "c", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", "trust", 2)], "host string, kind string, n long")
    got = {r["host"]: r["rank"] for r in urls.propagate(edges, seeds, rounds=1).collect()}
    assert got == {"a": urls.MASS * 15 // 100, "b": urls.MASS * 85 // 100 // 4 * 3, "c": urls.MASS * 85 // 100 // 4}


def test_empty_table_no_rules_and_repeated_rows(spark):
    assert judged(spark, []) == {}
    got = urls.judge(spark.createDataFrame([(1, "http://x.org/", None)] * 3 + [(None, None, None)], ROWS), [])
    assert got.where(F.col("verdict") == "allow").count() == 4


def test_registered_query_matches_sql(spark, sf, duck):
    from bulwark.llm.queries import QUERIES, SQL

    assert compare(QUERIES["op3_url_trust"](spark, sf), duck, SQL["op3_url_trust"]) == ""


def test_families_take_one_pass(spark):
    long = ".".join(f"l{i}" for i in range(1000)) + ".org"
    hosts = ["a.b.c.org", "b.c.org", "c.org", "org", "a..b", ".x.y", "x.y.", "", long]

    def plain(h):
        out = set()
        while "." in h.partition(".")[2]:
            out.add((h, h.partition(".")[2]))
            h = h.partition(".")[2]
        return out

    got = urls.family(spark.createDataFrame([(h,) for h in hosts], "src string"))
    assert {tuple(r) for r in got.collect()} == set().union(*map(plain, hosts))
    assert got.count() == len(set().union(*map(plain, hosts)))
