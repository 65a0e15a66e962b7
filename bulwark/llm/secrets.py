"""Secret scans: three patterns, and character Markov models of random strings against ordinary identifiers.

Everything is column expressions. Patterns give labelled samples: what they match is random, other long tokens are
ordinary. Pair counts of both become log-likelihood ratios, and a token of 16 characters or more whose summed ratio
passes a threshold is a span of its own kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulwark.functions.seeded import let
from bulwark.llm.common import doubles, without
from bulwark.session import checkpointed

# Kinds of spans in their order, and the patterns of the first three.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: A cheap test of whether a text can hold a match at all.
POSSIBLE = {
    ASSIGN: r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ACCESS: r"AKIA[A-Z0-9]{16}",
    HEX: r"[0-9a-f]{24}",
}

#: Tokens that count as ordinary, and how long one must be to be judged.
LEAST = 16
ORDINARY = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
WIDTH = len(ALPHABET) + 1  # 0: any other character

_SPAN = "struct<start: bigint, kind: int, end: bigint>"


#: Elements that a running total goes through one by one; their blocks are totalled first.
BLOCK = 64


def running(values: Column, combine) -> Column:
    """combine(first, ..., this one) at each place, for sums or maxima of longs of at least 0.

    A fold that appends to its result copies it each time. So each block of 64 values is folded for itself, from what
    the blocks in front of it come to.
    """
    zero = F.array(F.lit(0).cast("bigint"))

    def folded(part: Column, begin: Column) -> Column:
        return F.aggregate(part, begin, lambda done, x: F.concat(done, F.array(combine(F.element_at(done, -1), x))))

    def whole(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK))
        sums = F.transform(starts, lambda s: F.aggregate(F.slice(v, s, F.lit(BLOCK)), F.lit(0).cast("bigint"), combine))

        def from_blocks(before: Column) -> Column:
            parts = F.transform(starts, lambda s, k: folded(F.slice(v, s, F.lit(BLOCK)), F.array(F.get(before, k))))
            return F.flatten(F.transform(parts, lambda p: F.slice(p, F.lit(2), F.lit(BLOCK))))

        return let(folded(sums, zero), from_blocks)

    return let(F.transform(values, lambda x: x.cast("bigint")), whole)


def located(text: Column, pattern: str) -> Column:
    """Matches of the pattern, leftmost and not overlapping: (start, end, match) in code points.

    A text is split at its matches, and the lengths of pieces and matches in turn add up to the places.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(h: Column) -> Column:
        lengths = let(gaps, lambda g: F.transform(h, lambda m, i: F.length(m) + F.length(F.get(g, i))))
        return let(running(lengths, lambda x, y: x + y), lambda ends: F.transform(h, lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("match"))))

    return let(hits, placed)


def apart(tokens: Column, spans: Column) -> Column:
    """The tokens that overlap none of the spans, which are sorted by start and may overlap each other.

    Of the spans that begin before a token's end, found by a binary search, the furthest end decides.
    """

    def kept(b: Column, furthest: Column) -> Column:
        n = F.size(b)
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(27))])  # a text has fewer spans than 2**27

        def before(end: Column) -> Column:
            move = lambda at, s: F.when((at + s <= n) & (F.get(b, (at + s - 1).cast("int"))["start"] < end), at + s).otherwise(at)
            return F.aggregate(steps, F.lit(0), move)

        return F.filter(tokens, lambda t: F.coalesce(F.get(furthest, before(t["end"]) - 1) <= t["start"], F.lit(True)))

    found = let(spans, lambda b: let(running(F.transform(b, lambda x: x["end"]), lambda x, y: F.greatest(x, y)), lambda furthest: kept(b, furthest)))
    return F.when(F.size(spans) == 0, tokens).otherwise(found)


def matched(text: Column, pattern: str, keep) -> Column:
    """Located matches for which `keep(match)` holds; texts that can't hold one aren't searched."""
    none = F.array().cast("array<struct<start: bigint, end: bigint, match: string>>")
    return F.when(text.rlike(POSSIBLE.get(pattern, pattern)), F.filter(located(text, pattern), lambda m: keep(m["match"]))).otherwise(none)


def assigned_value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def pairs(token: Column) -> Column:
    """A number for each pair of neighbouring characters; a place outside the token in front of the first."""
    places = F.sequence(F.lit(1), F.length(token))

    def number(i: Column) -> Column:
        before = F.when(i > 1, F.instr(F.lit(ALPHABET), F.substring(token, i - 1, F.lit(1)))).otherwise(0)
        return before * WIDTH + F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))

    return F.transform(places, number)


#: Weight of a character's overall share in its share after another one.
BACKOFF = 5.0


def ratios(counts: dict[bool, dict[int, int]]) -> list[float]:
    """log P(character | one before, random) - log P(the same, ordinary); pairs back off to single characters.

    Each pair of the ordinary sample counts one less than it was seen: a secret that no pattern matched is in that
    sample too, and must not vouch for itself.
    """
    logs = {}
    for random in (True, False):
        mine, less = counts.get(random, {}), 0 if random else 1
        rows = [[mine.get(a * WIDTH + b, 0) for b in range(WIDTH)] for a in range(WIDTH)]
        alone = [sum(row[b] for row in rows) + 0.5 for b in range(WIDTH)]
        share = [c / sum(alone) for c in alone]
        logs[random] = []
        for row in rows:
            spare = BACKOFF + less * sum(c > 0 for c in row)
            logs[random] += [math.log((max(c - less, 0) + spare * p) / (sum(row) + BACKOFF)) for c, p in zip(row, share, strict=True)]
    return [r - o for r, o in zip(logs[True], logs[False], strict=True)]


def as_spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def scan(docs: DataFrame, text_col: str = "text", ordinary_rows: int = 20_000, odds: float = 1000.0) -> DataFrame:
    """Columns of docs but the text, plus `spans`: (start, kind, end) by start, then kind; kind indexes KINDS.

    Spans are code points, ends exclusive. The first three kinds follow their patterns; the fourth are tokens whose
    characters are `odds` times likelier under the random model, after the ratio of tokens in all docs; they never
    overlap the others. Random samples are all pattern matches of all docs; ordinary tokens are those of 8
    characters or more that overlap no match. They are counted in all docs, so that the threshold is that of the text and not of the table's
    size. Pairs are counted once for each distinct text, random ones in all and ordinary ones in about
    `ordinary_rows` texts, drawn by a digest; both come down to one count for each pair of characters. So repeated
    rows change no span. Texts are hashed once and searched once, and never shuffled.
    Work grows with the text and the logarithm of its matches.
    Defined cases: a null text is empty; without random or without ordinary samples only patterns count; an empty
    table gives an empty result; input columns named spans are replaced.
    """
    rows = without(docs, "spans")
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = rows.agg(F.approx_count_distinct(F.xxhash64(text))).first()[0]  # repeated rows don't move it
    drawn = F.pmod(F.xxhash64(F.lit(5), text), F.lit(max(1, n))) < ordinary_rows
    kept = [c for c in rows.columns if c.lower() != text_col.lower()]
    found = rows.select(
        *[F.col(f"`{c}`") for c in kept],
        matched(text, ASSIGN, lambda m: F.length(assigned_value(m)) >= 6).alias("__assign"),
        matched(text, ACCESS, lambda m: F.length(m) >= 20).alias("__access"),
        matched(text, HEX, lambda m: F.length(m) >= 24).alias("__hex"),
        matched(text, ORDINARY, lambda m: F.lit(True)).alias("__tokens"), drawn.alias("__drawn"), F.xxhash64(text).alias("__text"),
    )
    patterns = ["__assign", "__access", "__hex"]
    base = F.concat(*[as_spans(F.col(c), k) for k, c in enumerate(patterns)])
    values = F.concat(F.transform("__assign", lambda m: assigned_value(m["match"])), *[F.transform(c, lambda m: m["match"]) for c in patterns[1:]])
    based = found.withColumns({"__base": F.array_sort(base), "__random": values})
    plain = based.withColumn("__plain", apart(F.col("__tokens"), F.col("__base")))
    ordinary = F.when(F.col("__drawn"), F.transform("__plain", lambda t: t["match"]))
    held = checkpointed(
        plain.select(
            *[F.col(f"`{c}`") for c in kept], "__base", "__random", F.filter("__plain", lambda t: F.length(t["match"]) >= LEAST).alias("__free"),
            ordinary.alias("__ordinary"), F.size("__plain").alias("__n_ordinary"), "__text",
        )
    )
    texts = held.where((F.size("__random") > 0) | (F.size("__ordinary") > 0)).select("__text", "__random", "__ordinary").dropDuplicates(["__text"])
    samples = texts.select(F.explode(F.array(F.struct(F.lit(True).alias("random"), F.col("__random").alias("t")), F.struct(F.lit(False).alias("random"), F.col("__ordinary").alias("t")))).alias("s"))
    samples = samples.select("s.random", F.explode("s.t").alias("token"))
    total = held.agg(F.sum(F.size("__random")).alias("random"), F.sum("__n_ordinary").alias("ordinary")).first()
    drawn_any = held.where(F.size("__ordinary") > 0).limit(1).count() if total["random"] and total["ordinary"] else 0
    if not drawn_any:
        extra = F.array().cast(f"array<{_SPAN}>")
    else:
        counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
        for r in samples.select("random", F.explode(pairs(F.col("token"))).alias("p")).groupBy("random", "p").agg(F.count("*").alias("n")).collect():
            counts[r["random"]][r["p"]] = r["n"]
        table = doubles(ratios(counts))
        least = max(0.0, math.log(total["ordinary"] / total["random"])) + math.log(odds)
        score = lambda t: F.aggregate(pairs(t["match"]), F.lit(0.0), lambda s, p: s + F.get(table, p))
        extra = as_spans(F.filter("__free", lambda t: score(t) > least), 3)
    return held.withColumn("spans", F.array_sort(F.concat("__base", extra))).select(*[F.col(f"`{c}`") for c in kept], "spans")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
