"""Benchmark decontamination with an FM-index of every training shard.

A shard is a run of whole documents. Its words become symbols: a word of the benchmark has its own, and a run of
words that no benchmark text holds is one separator, as is the end of a document. The shard's suffixes are sorted,
the Burrows-Wheeler transform goes into a wavelet tree of bit vectors with rank counts, and all test phrases are
searched backwards at once. Occurrences are located by stepping back to sampled suffix positions, turned into word
spans and merged for each document.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulwark.llm.common import plainly_named
from bulwark.llm.words import ALNUM, Words, cut

WINDOW = 10
SHARD_BYTES = 3 << 20
SAMPLE_EVERY = 16
# Benchmark words that one search holds; a larger benchmark is searched in several blocks of items.
BLOCK_WORDS = 1_000_000


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols, and which items hold each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        hashes, rows = [], [i for i, _ in items]
        held: dict[tuple, set] = {}
        for words in cut(pa.array([t for _, t in items], pa.large_string()), ALNUM):
            for r in range(len(words.word_at) - 1):
                h = words.hashes[words.word_at[r] : words.word_at[r + 1]].tolist()
                hashes += h
                for i in range(max(1, len(h) - window + 1) if h else 0):
                    held.setdefault(tuple(h[i : i + window]), set()).add(rows[words.first_row + r])
        self.words = np.unique(np.array(hashes, np.uint64))
        self.length = np.array([len(p) for p in held], np.int64)
        self.symbols = np.zeros((len(held), window), np.int64)  # right-aligned
        for i, p in enumerate(held):
            self.symbols[i, window - len(p) :] = np.searchsorted(self.words, np.array(p, np.uint64)) + 1
        items = [sorted(i for i in x if i is not None) for x in held.values()]
        self.item_at = np.concatenate(([0], np.cumsum([len(x) for x in items]))).astype(np.int64)
        self.item_ids = np.array([i for x in items for i in x], np.int64)
        bits = max(1, min(20, len(self.words).bit_length() + 2))
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.words >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.starts).max(initial=0))

    def items_of(self, phrases: np.ndarray) -> list[int]:
        """Ids of the items that hold any of the phrases, sorted."""
        return np.unique(np.concatenate([self.item_ids[self.item_at[p] : self.item_at[p + 1]] for p in phrases.tolist()])).tolist()

    def symbols_of(self, h: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 for a word of no item."""
        lead = (h >> self.shift).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        out = np.zeros(len(h), np.int64)
        for k in range(self.most):
            i = np.flatnonzero(at + k < end)
            hit = i[self.words[at[i] + k] == h[i]]
            out[hit] = at[hit] + k + 1
        return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of s (not negative) in order; a suffix comes before its extensions. Doubling, ties only."""
    n, width = len(s), (int(s.max()) + 1).bit_length()
    place = max(1, (n - 1).bit_length())
    take = max(1, min(4, (63 - place) // width))
    key = np.zeros(n, np.int64)
    for k in range(take):
        key <<= width
        key[: max(0, n - k)] |= s[k:] + 1
    at = np.sort((key << place) | np.arange(n)) & ((1 << place) - 1)
    head = np.concatenate(([True], key[at[1:]] != key[at[:-1]]))
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    rank[at] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = take
    while True:
        single = head & np.concatenate((head[1:], [True]))
        tied = np.flatnonzero(~single)
        if not len(tied):
            return at
        sub = at[tied]
        second = rank[np.minimum(sub + step, n)] + 1
        if 3 * place + 1 <= 63:
            packed = np.sort(((rank[sub] << (place + 1) | second) << place) | sub)
            sub, first2 = packed & ((1 << place) - 1), packed >> place
        else:
            first2 = rank[sub] << (place + 1) | second
            order = np.argsort(first2, kind="stable")
            sub, first2 = sub[order], first2[order]
        at[tied] = sub
        new = np.concatenate(([True], first2[1:] != first2[:-1]))
        head[tied] = new | head[tied]
        rank[at[tied]] = np.maximum.accumulate(np.where(new, tied, 0))
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector for each bit of a symbol, with counts of ones."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.levels = max(1, (sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = ((s >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate((packed, np.zeros(8 + (-len(packed)) % 8, np.uint8))).view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(len(s) - int(bit.sum()))
            s = np.concatenate((s[~bit], s[bit]))
        self.begin = self._down(np.zeros(sigma, np.int64), np.arange(sigma))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = self.words[level][word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def _down(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones = self._ones(level, i)
            i = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of position i."""
        return self._down(i, symbol) - self.begin[symbol]

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(i), np.int64)
        for level in range(self.levels):
            bit = ((self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(level, i)
            i = np.where(bit, self.zeros[level] + ones, i - ones)
            symbol = symbol << 1 | bit
        return symbol, i - self.begin[symbol]


class FMIndex:
    """Backward search and location in a sequence of symbols 0 to sigma - 1. Inside, 0 is an end of its own."""

    def __init__(self, s: np.ndarray, sigma: int):
        s, sigma = np.append(s + 1, 0), sigma + 1
        at = suffix_array(s)
        self.tree = WaveletTree(s[at - 1], sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=sigma))))
        self.n = len(s)
        sampled = at % SAMPLE_EVERY == 0
        self.marked = WaveletTree(sampled.astype(np.int64), 2)
        self.samples = at[sampled]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each right-aligned phrase the range of suffixes that begin with it."""
        count, width = phrases.shape
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        alive = np.arange(count)
        for k in range(width):
            alive = alive[(high[alive] > low[alive]) & (length[alive] > k)]
            c = phrases[alive, width - 1 - k] + 1
            low[alive] = self.before[c] + self.tree.rank(c, low[alive])
            high[alive] = self.before[c] + self.tree.rank(c, high[alive])
        return low, np.maximum(low, high)

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by stepping back to a sampled one."""
        out, steps = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        todo, i = np.arange(len(i)), i.copy()
        while len(todo):
            bit, rank = self.marked.symbol_and_rank(i)
            hit = bit == 1
            out[todo[hit]] = self.samples[rank[hit]] + steps[todo[hit]]
            todo, i = todo[~hit], i[~hit]
            c, rank = self.tree.symbol_and_rank(i)
            i = self.before[c] + rank
            steps[todo] += 1
        return out


def shard_hits(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: phrase, first word, word behind the last."""
    symbols = phrases.symbols_of(words.hashes)
    nothing = np.zeros(0, np.int64)
    if not symbols.any() or not len(phrases.length):
        return nothing, nothing, nothing
    # Document ends become separators of their own; then every run of separators is one.
    ends = words.word_at[1:-1]
    s = np.insert(symbols, ends, 0)
    word = np.insert(np.arange(len(symbols)), ends, -1)
    keep = (s != 0) | np.concatenate(([True], s[:-1] != 0))
    s, word = s[keep], word[keep]
    index = FMIndex(s, len(phrases.words) + 1)
    low, high = index.search(phrases.symbols, phrases.length)
    found = high - low
    which = np.repeat(np.arange(len(low)), found)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
    at = word[index.locate(low[which] + offset)] if len(which) else nothing
    return which, at, at + phrases.length[which]


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge spans that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return s[new], np.append(e[:-1][new[1:]], e[-1])


def find(docs: DataFrame, text_col: str, items: list[tuple[int, str | None]], window: int) -> DataFrame:
    """Columns of docs (all but text_col) plus n_words, items (ids found, sorted), and spans.

    spans: list of (word, word_end, start, end): words from 0, places as code points, ends exclusive.
    """
    context = docs.sparkSession.sparkContext
    kept = [c for c in docs.columns if c != text_col]
    shared = context.broadcast(Phrases(items, window))  # made once for a block; a block's size is bounded
    schema = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept],
                        "n_words long, items array<bigint>, spans array<struct<word: bigint, word_end: bigint, start: bigint, end: bigint>>"])
    span = pa.list_(pa.struct([(x, pa.int64()) for x in ("word", "word_end", "start", "end")]))
    position = docs.columns.index(text_col)

    def run(batches):
        phrases = shared.value
        for b in batches:
            n_words, found, spans = [], [], []
            for words in cut(b.column(position), ALNUM, SHARD_BYTES):
                which, start, end = shard_hits(words, phrases)
                doc = np.searchsorted(words.word_at, start, "right") - 1
                rows: dict[int, np.ndarray] = {}
                if len(doc):
                    order = np.argsort(doc, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                        rows[int(doc[part[0]])] = part
                for r in range(len(words.word_at) - 1):
                    n_words.append(int(words.word_at[r + 1] - words.word_at[r]))
                    if r not in rows:
                        found.append([])
                        spans.append([])
                        continue
                    part = rows[r]
                    found.append(phrases.items_of(np.unique(which[part])))
                    s, e = union(start[part], end[part])
                    lead = (words.data[words.text_at[r] : words.text_at[r + 1]] & 0xC0) != 0x80
                    code = np.concatenate(([0], np.cumsum(lead)))
                    c0, c1 = code[words.starts[s] - words.text_at[r]], code[words.ends[e - 1] - words.text_at[r]]
                    s, e = s - words.word_at[r], e - words.word_at[r]
                    spans.append([dict(zip(("word", "word_end", "start", "end"), x, strict=True)) for x in zip(s.tolist(), e.tolist(), c0.tolist(), c1.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], pa.array(n_words, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(spans, span)],
                [*kept, "n_words", "items", "spans"],
            )

    return docs.mapInArrow(run, schema)


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> tuple[int, Iterator[list[tuple[int, str | None]]]]:
    """How many blocks of about `block_words` words (or one item) the benchmark has, and the blocks, fetched one by one."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // (block_words * 4)))
    dealt = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    return n, ([(r["i"], r["t"]) for r in dealt.where(F.col("b") == k).select("i", "t").collect()] for k in range(n))


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    bench_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of docs: its other columns, n_words, items (sorted ids) and merged spans. Nothing is shuffled.

    A window is `window` neighbouring words of an item, or the whole of a shorter item. The benchmark is a stated
    query set: block after block of it travels with the tasks, each of a bounded size and the only one on the driver; with more than one block the
    docs are read once for each, and results are joined in the row.
    Defined cases: null texts and texts without words have no spans; null benchmark texts have no windows; items that
    repeat a text are all reported; item ids are numbers (cast to long, others are an error); a null item id is not
    reported, though its spans are; an empty benchmark finds
    nothing; input columns n_words, items and spans are replaced.
    """
    added = ("n_words", "items", "spans")
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in added])
    n, parts = blocks(benchmark, item_col, bench_text_col, block_words)
    if n == 1:
        return find(docs, text_col, next(parts), window)
    rest = [c for c in docs.columns if c != text_col]
    # Each block passes the text on to the next one; only the last result leaves it out.
    out = docs.withColumns({"items": F.array().cast("array<bigint>"), "spans": F.array().cast(SPANS)})
    for part in parts:
        known = [c for c in out.columns if c not in ("items", "spans")]
        held = out.select(*known, F.col("items").alias("__items"), F.col("spans").alias("__spans"), F.col(text_col).alias("__text"))
        found = find(held.drop("n_words"), "__text", part, window)
        out = found.select(
            *[c for c in found.columns if c not in ("__items", "__spans", "items", "spans")],
            F.array_sort(F.array_union("__items", "items")).alias("items"),
            merged(F.concat("__spans", "spans")).alias("spans"),
        )
    return out.select(*rest, *added)


SPANS = "array<struct<word: bigint, word_end: bigint, start: bigint, end: bigint>>"


def merged(spans: Column) -> Column:
    """Merge sorted-up spans that overlap or touch in words."""

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(
            last["word"].alias("word"), F.greatest(last["word_end"], x["word_end"]).alias("word_end"),
            last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"),
        )
        touch = (F.size(done) > 0) & (x["word"] <= last["word_end"])
        return F.when(touch, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of docs with every merged span cut out of the text; a row of which no word remains goes.

    Rows without a span are untouched, and so are all other columns. Defined cases as for `occurrences`.
    """
    held, name = plainly_named(docs)
    text = name[text_col]
    found = occurrences(held.withColumn("__text", F.col(text)), benchmark, "__text", window=window)
    gaps = F.concat(F.array(F.lit(0).cast("bigint")), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(F.lit(2**31 - 1).cast("bigint")))
    kept = F.zip_with(gaps, ends, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    clean = F.when(F.size("spans") > 0, F.concat_ws("", kept)).otherwise(F.col(text))
    cut_words = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["word_end"] - x["word"])
    out = found.where((F.size("spans") == 0) | (cut_words < F.col("n_words"))).withColumn(text, clean)
    return out.select(*name.values()).toDF(*docs.columns)
