"""URL filters: rules by host and path, and trust propagated over the graph of hosts.

A rule decides the urls that it fits. Hosts of allowed pages are trusted seeds, hosts of blocked pages are distrusted
seeds. Trust is a personalised PageRank from the first along links; distrust one from the second against them, so
that who links to blocked hosts loses. A host with more distrust than its threshold allows is blocked, and with it
the pages that no rule fits. Ranks are whole numbers, so no order of sums changes a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulwark.session import checkpointed

MASS = 10**15
#: Ranks are settled when a round adds no more than this to all of them together, and reaches no further host.
SETTLED = MASS // 10**6
#: Rounds of the registered query, whose SQL states as many.
ROUNDS = 8
#: Percent of a rank that moves on along the links; the rest starts anew at the seeds.
DAMPING = 85
#: A host is blocked if distrust is more than this percentage of its trust and distrust together.
THRESHOLD = 50
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # allow or block, host, path


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER), F.regexp_extract(url, parts, 2)


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. Equally long rules: the first one. For lists of a stated size."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):  # the last one tried is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def family(hosts: DataFrame) -> DataFrame:
    """(h, p), distinct: each host and the parents above it, with the next parent of each, as long as two labels are left.

    One pass whatever the number of labels: a host gives a row for each of its dots.
    """
    labels = F.size(F.split(F.col("src"), r"\.", -1))
    up = hosts.where(labels > 2).select("src", F.explode(F.sequence(labels, F.lit(3), F.lit(-1))).alias("k"))
    rest = lambda k: F.call_function("substring_index", F.col("src"), F.lit("."), k)
    return up.select(rest(-F.col("k")).alias("h"), rest(1 - F.col("k")).alias("p")).distinct()


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted; a host and its parent domain are linked both ways.

    pages: host, html. Counts are combined before the shuffle, so a host with a third of all pages is no burden.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    targets = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER))
    found = checkpointed(pages.where("host <> ''").select(F.col("host").alias("src"), F.explode_outer(targets).alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("n")))
    links = found.where("dst is not null and src <> dst")
    hosts = found.select("src").union(links.select("dst")).distinct()
    up = checkpointed(family(hosts))
    both = up.select(F.col("h").alias("src"), F.col("p").alias("dst")).union(up.select(F.col("p").alias("src"), F.col("h").alias("dst")))
    links = links.unionByName(both.withColumn("n", F.lit(1).cast("long")))
    return links.groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: int = DAMPING) -> DataFrame:
    """(host, kind, rank), settled, or after some rounds. edges: src, dst, n. seeds: host, kind (trust or distrust), n.

    Each kind starts with the same mass, dealt by n. Trust moves along the links, distrust against them, by the
    share of n; what reaches a host without links ends there. Without a number of rounds, ranks start with what the
    seeds get anew in each round. From there no rank ever falls, whatever is rounded, so they settle on any graph.
    """
    ways = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    )
    out = ways.groupBy("kind", "host").agg(F.sum("n").alias("out"))
    ways = checkpointed(ways.join(out, ["kind", "host"]))
    totals = seeds.groupBy("kind").agg(F.sum("n").alias("total"))  # two rows at most
    start = checkpointed(seeds.join(F.broadcast(totals), "kind").select("kind", "host", (F.call_function("div", F.lit(MASS), F.col("total")) * F.col("n")).alias("rank")))
    again = start.select("kind", "host", F.call_function("div", F.col("rank") * (100 - damping), F.lit(100)).alias("rank"))
    zero = F.lit(0).cast("long")
    ranks = start if rounds is not None else checkpointed(again)
    done = 0
    while rounds is None or done < rounds:
        share = F.call_function("div", F.call_function("div", F.col("rank") * damping, F.lit(100)), F.col("out")) * F.col("n")
        moved = ranks.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), share.alias("rank"))
        added = moved.unionByName(again)
        done += 1
        if rounds is not None:
            ranks = checkpointed(added.groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
            continue
        both = added.withColumn("before", zero).unionByName(ranks.select("kind", "host", zero.alias("rank"), F.col("rank").alias("before")))
        both = checkpointed(both.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before")))
        ranks = both.drop("before")
        change, reached = both.agg(F.coalesce(F.sum(F.abs(F.col("rank") - F.col("before"))), zero), F.count(F.when((F.col("before") == 0) & (F.col("rank") > 0), 1))).first()
        if change <= SETTLED and not reached:
            break
    return ranks


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: int = THRESHOLD, rounds: int | None = None) -> DataFrame:
    """Per row of pages: its id, host, path, rule, verdict, trust, distrust. Ranks are settled unless rounds are given.

    Defined cases: a null url and one without :// have an empty host and path, fit no rule, and are allowed, as are
    hosts that neither rank reaches; null html has no links; without seeds of a kind that rank is 0; further columns
    are not read; an empty table gives an empty result; every row is judged, however often it is repeated.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"), host.alias("host"), path.alias("path"))
    decided = rows.withColumn("by", deciding_rule(F.col("host"), F.col("path"), rules))
    seeds = checkpointed(
        decided.where("by is not null").select("host", F.when(F.col("by.verdict") == "allow", "trust").otherwise("distrust").alias("kind"))
        .groupBy("host", "kind").agg(F.count("*").alias("n"))
    )
    ranks = propagate(host_edges(rows), seeds, rounds)
    by_host = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0)).alias("distrust"),
    )
    by_host = checkpointed(by_host.withColumn("blocked", F.col("distrust") * 100 > (F.col("trust") + F.col("distrust")) * threshold))
    verdict = F.coalesce(F.col("by.verdict"), F.when(F.col("blocked"), "block").otherwise("allow"))
    return (
        decided.drop("html").join(by_host, "host", "left")
        .select(F.col("id").alias(id_col), "host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"),
                F.coalesce("trust", F.lit(0).cast("long")).alias("trust"), F.coalesce("distrust", F.lit(0).cast("long")).alias("distrust"))
    )
