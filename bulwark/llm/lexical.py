"""Ranked lexical search by NRA (no random access).

Documents are cut into words once and leave a forward row: their length and the frequency of each term that some
item asks for. Tasks turn neighbouring rows into an index block, one list for each term, sorted by impact. For each
item the lists are read from the top down, in step. A document's lower bound is the sum of the impacts seen, its
upper bound adds the next impact of every list in which it wasn't seen. Reading ends when every document that could
still be among the best is known exactly, so membership, order, ties and scores are final. The best of all blocks
are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulwark.llm.words import ALNUM, Words, cut
from bulwark.session import checkpointed, spread

#: Terms of items that are searched at once (pairs of item and term), postings of an index block.
BLOCK_TERMS, BLOCK_POSTINGS = 1_000_000, 2_000_000
#: Impacts read from each list in the first turn; each further turn reads twice as many.
FIRST_READS = 128
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_fold = np.arange(256, dtype=np.uint8)
_fold[0x41:0x5B] += 32


@dataclass
class Vocabulary:
    """Terms in the order of their hashes, with their bytes, to find them in texts."""

    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    alike: int  # terms that share one hash at most

    @classmethod
    def of(cls, terms: list[str]) -> tuple[Vocabulary, np.ndarray]:
        """The vocabulary, and each given term's place in it."""
        hashes, data, starts, ends, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for w in cut(pa.array(terms, pa.string()), ALNUM):
            hashes.append(w.hashes)
            data.append(w.data)
            starts.append(w.starts + n)
            ends.append(w.ends + n)
            n += len(w.data)
        hashes, starts, ends = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        _, alike = np.unique(hashes, return_counts=True)
        return cls(hashes[order], _fold[np.concatenate(data)], starts[order], (ends - starts)[order], int(alike.max(initial=0))), place

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and which terms. A hash only proposes: bytes are compared."""
        at, found, terms = np.searchsorted(self.hashes, words.hashes), [], []
        for turn in range(self.alike):
            term = np.minimum(at + turn, len(self.hashes) - 1)
            word = np.flatnonzero((self.hashes[term] == words.hashes) & (self.sizes[term] == words.ends - words.starts))
            term = term[word]
            size = self.sizes[term]
            first = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(first, size)
            same = _fold[words.data[np.repeat(words.starts[word], size) + step]] == self.data[np.repeat(self.starts[term], size) + step]
            good = np.logical_and.reduceat(same, first) if len(word) else np.zeros(0, bool)
            found.append(word[good])
            terms.append(term[good])
        return (np.concatenate(found), np.concatenate(terms)) if found else (np.zeros(0, np.int64),) * 2


def forward_rows(docs: DataFrame, id_col: str, text_col: str, vocabulary: Vocabulary) -> DataFrame:
    """id, n (words of the text), terms and frequencies (of the vocabulary's terms) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            n, sizes, terms, counts = [], [], [], []
            for w in cut(b.column(1), ALNUM):
                rows = len(w.word_at) - 1
                word, term = known.places(w)
                row = np.searchsorted(w.word_at, word, "right") - 1
                pair, count = np.unique(row * len(known.hashes) + term, return_counts=True)
                row, term = (pair // len(known.hashes), pair % len(known.hashes)) if len(pair) else (pair, pair)
                n.append(np.diff(w.word_at))
                sizes.append(np.bincount(row, minlength=rows))
                terms.append(term)
                counts.append(count)
            whole = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (n, sizes, terms, counts)]
            offsets = pa.array(np.concatenate(([0], np.cumsum(whole[1]))), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in whole[2:]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole[0]), *lists], ["id", "n", "terms", "counts"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return spread(texts, "id").mapInArrow(run, "id long, n long, terms array<int>, counts array<int>")


@dataclass
class Index:
    """Impact-sorted lists of a block of documents, which are numbered by ascending id."""

    ids: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> Index:
        by_id = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[by_id] = np.arange(len(ids))
        some = impacts > 0
        docs, terms, impacts = rank[docs[some]], terms[some], impacts[some]
        order = np.lexsort((docs, -impacts, terms))
        return cls(ids[by_id], docs[order], impacts[order], np.searchsorted(terms[order], np.arange(n_terms + 1)))


def _sums(docs: np.ndarray, weights: np.ndarray, n: int, most: int) -> np.ndarray:
    """Exact integer sums of weights by document; `most` bounds each."""
    if most < 2**53:
        return np.bincount(docs, weights, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, docs, weights)
    return out


def nra(index: Index, terms: np.ndarray, k: int, best: list[tuple[int, int]], first_reads: int = FIRST_READS) -> tuple[list[tuple[int, int]], int]:
    """The k best (-score, id) of `best`, which other blocks gave, and of this block; and how many impacts were read."""
    starts, ends = index.starts[terms], index.starts[terms + 1]
    lists = ends > starts
    starts, ends = starts[lists], ends[lists]
    n = len(index.ids)
    most = int(index.impacts[starts].sum()) if len(starts) else 0
    docs = [np.zeros(0, np.int64)]
    which = [np.zeros(0, np.int64)]
    lower = np.zeros(n, np.int64)
    at, step = starts.copy(), first_reads
    other_score = np.array([-s for s, _ in best], np.int64)
    other_id = np.array([i for _, i in best], np.int64)
    while True:
        upto = np.minimum(at + step, ends)
        for t in np.flatnonzero(upto > at):
            docs.append(index.docs[at[t] : upto[t]])
            which.append(np.full(upto[t] - at[t], t))
            lower[docs[-1]] += index.impacts[at[t] : upto[t]]  # a document stands once in a list
        at, step = upto, step * 2
        open_ = at < ends
        following = np.where(open_, index.impacts[np.minimum(at, max(len(index.impacts) - 1, 0))], 0) if len(at) else np.zeros(0, np.int64)
        docs, which = [np.concatenate(docs)], [np.concatenate(which)]
        upper = lower + int(following.sum())
        if open_.any():
            upper -= _sums(docs[0], following[which[0]], n, most)
        # The k-th best by lower bounds, ties to the smaller id.
        score, ids = np.concatenate((other_score, lower)), np.concatenate((other_id, index.ids))
        kth, kth_id = 0, -(2**63)
        if len(score) >= k and (kth := int(np.partition(score, len(score) - k)[len(score) - k])) > 0:
            level = np.sort(ids[score == kth])
            kth_id = int(level[k - 1 - int((score > kth).sum())])
        rivals = np.flatnonzero((upper > kth) | ((upper == kth) & (upper > 0) & (index.ids <= kth_id)))
        if (upper[rivals] == lower[rivals]).all():
            mine = [(-s, i) for s, i in zip(lower[rivals].tolist(), index.ids[rivals].tolist(), strict=True)]
            return sorted([*best, *mine])[:k], len(docs[0])


def best_of_blocks(rows: DataFrame, items: list[np.ndarray], weights: np.ndarray, lengths: tuple[int, int], k: int) -> DataFrame:
    """item (a number), id, score: of each task's documents the k best for each item."""
    n_docs, n_words = lengths
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))

    def indexed(held: list[pa.RecordBatch], weight: np.ndarray) -> Index:
        t = pa.Table.from_batches(held)
        n, sizes = t.column("n").to_numpy(), np.concatenate([np.diff(c.offsets.to_numpy()) for c in t.column("terms").chunks])
        term, tf = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t.column(x).chunks]).astype(np.int64) for x in ("terms", "counts"))
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 10 + (90 * n * n_docs) // max(n_words, 1)
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        return Index.of(t.column("id").to_numpy(), doc, term, impact, len(weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        held, postings = [], 0

        def search() -> None:
            index = indexed(held, weight)
            for i, terms in enumerate(asked):
                best[i], _ = nra(index, terms, k, best[i])

        for b in batches:
            held.append(b)
            postings += len(b) + len(b.column("terms").flatten())
            if postings >= BLOCK_POSTINGS:
                search()
                held, postings = [], 0
        if postings:
            search()
        found = [(i, d, -s) for i, rows in enumerate(best) for s, d in rows]
        columns = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "id", "score"])

    return rows.where("id is not null").mapInArrow(run, "item int, id long, score long")


def term_weight(n: int, df: int) -> int:
    """floor(1000 * ln((2n + 2) / (2df + 1)))"""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_col, rank (from 1), doc_id, score: for each item its k best documents with a score, all if there are fewer.

    The items are a stated query set; they are searched in blocks of about `block_terms` terms (one item's terms must
    fit a task), and documents are read once for each block. A task holds one index block of about two million
    postings at a time and carries each item's best on to its next block.
    Defined cases: null texts have no terms; rows that share an item id are one item with all their terms; items
    without a known term find nothing; documents without an id count in the statistics and are never ranked, and
    rows that share an id are ranked each for itself; ids are cast to long; further columns are not read; empty tables
    give no rows. Statistics cover all documents. Scores are exact below 2**63.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.explode(words_of(F.col(f"`{item_text_col}`"))).alias("term")).distinct()
    asked = checkpointed(asked)
    blocks = max(1, -(-asked.count() // block_terms))
    parts = []
    for block in range(blocks):
        pairs = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not len(pairs):
            continue
        terms = pairs.column("term").combine_chunks().dictionary_encode()
        vocabulary, place = Vocabulary.of(terms.dictionary.to_pylist())
        term = place[terms.indices.to_numpy()]
        names = pairs.column("item_id").to_pylist()
        numbers: dict = {}
        number = np.array([numbers.setdefault(i, len(numbers)) for i in names])
        order = np.lexsort((term, number))
        lists = np.split(term[order], np.flatnonzero(np.diff(number[order])) + 1)
        rows = checkpointed(forward_rows(docs, id_col, text_col, vocabulary))
        n_docs, n_words = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # one row a term of the block
        weights = np.array([term_weight(n_docs, frequency.get(t, 0)) for t in range(len(place))], np.int64)
        found = best_of_blocks(rows, lists, weights, (n_docs, n_words), k)
        named = spark.createDataFrame([(n, i) for i, n in numbers.items()], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        order_of = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
        top = found.withColumn("rank", F.row_number().over(order_of)).where(F.col("rank") <= k)
        top = top.join(F.broadcast(named), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias("doc_id"), "score")
        parts.append(checkpointed(top) if blocks > 1 else top)
    if not parts:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
