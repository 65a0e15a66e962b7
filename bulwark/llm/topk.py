"""Exact top-k search by integer inner product, pruned a block at a time.

Rows are ordered so that alike vectors are neighbours and cut into blocks. A block has a forward index (its vectors)
and, for each term (a dimension), the largest and smallest weight in it. For a query the sum of its best terms
bounds every score of a block; blocks are visited from the highest bound down until a bound falls below the k-th
score, so no score that counts is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 256
#: Rows and queries that meet in one task. Both sides are cut into such parts, whatever their size.
LANE_ROWS, LANE_QUERIES = 32768, 2048


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, as longs; null if the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: F.floor(v.cast("double") * scale))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.when(~bad, x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, width), np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in the narrowest type that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k best rows other than its own id: (queries, k) positions in rows, -1 where there are fewer, and scores.

    The third result is how many blocks each query scored. Ties go to the smaller id, as positions follow ids.
    """
    by_id = np.argsort(ids, kind="stable")
    # Blocks hold alike vectors: rows in the order of their heaviest dimension.
    heavy = np.abs(rows).argmax(axis=1) if rows.shape[1] else np.zeros(len(rows), np.int64)
    side = rows[np.arange(len(rows)), heavy] > 0 if rows.shape[1] else heavy > 0
    order = np.lexsort((ids, side, heavy))
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    starts = np.arange(0, len(rows), BLOCK_ROWS)
    top, bottom = (f.reduceat(rows[order], starts, axis=0) for f in (np.maximum, np.minimum))
    bound = _product(np.maximum(queries, 0), top) + _product(np.minimum(queries, 0), bottom)
    visits = np.argsort(-bound, axis=1, kind="stable")
    worst = np.iinfo(np.int64).min // 2  # its negative exists
    score = np.full((len(queries), k), worst)
    place = np.full((len(queries), k), np.iinfo(np.int64).max)
    alive, visited = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    for turn in range(len(starts)):
        block = visits[alive, turn]
        go = bound[alive, block] >= score[alive, k - 1]
        alive, block = alive[go], block[go]
        if not len(alive):
            break
        visited[alive] += 1
        by_block = np.argsort(block, kind="stable")
        for part in np.split(by_block, np.flatnonzero(np.diff(block[by_block])) + 1):
            mine = alive[part]
            inside = order[starts[block[part[0]]] : starts[block[part[0]]] + BLOCK_ROWS]
            s = _product(queries[mine], rows[inside])
            own = ids[inside][None, :] == query_ids[mine][:, None]
            p = np.broadcast_to(rank[inside], s.shape)
            s = np.concatenate((score[mine], np.where(own, worst, s)), axis=1)
            p = np.concatenate((place[mine], np.where(own, np.iinfo(np.int64).max, p)), axis=1)
            if s.shape[1] > 4 * k:  # what scores below the k-th score needs no sorting
                least = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
                few = max(k, int((s >= least[:, None]).sum(axis=1).max()))
                if few < s.shape[1]:
                    pick = np.argpartition(-s, few - 1, axis=1)[:, :few]
                    s, p = np.take_along_axis(s, pick, 1), np.take_along_axis(p, pick, 1)
            pick = np.lexsort((p, -s), axis=1)[:, :k]
            score[mine], place[mine] = np.take_along_axis(s, pick, 1), np.take_along_axis(p, pick, 1)
    found = place < len(ids)
    return np.where(found, by_id[np.minimum(place, len(ids) - 1)], -1), score, visited


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its k best other rows, all if there are fewer.

    The queries are a stated set, and meet all rows part by part: a task holds at most about 32768 rows and 2048
    queries and gives k rows for each query; the best of all parts are ranked.
    Defined cases: vectors that are null, or hold a null or non-finite component, take no part, nor do rows without
    an id; vectors with fewer dimensions count as if filled with zeros; rows that share an id are separate
    candidates, and none of them is a candidate of their own id's query, which is asked once with one of them (the
    smallest vector); further columns are not read; an empty table gives no rows. Scores are exact below 2**62.
    """
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    clean = clean.where("id is not null and v is not null")
    n, asked, width = clean.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    lanes, parts = max(1, -(-n // LANE_ROWS)), max(1, -(-asked // LANE_QUERIES))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    clean = clean.withColumn("v", F.concat("v", zeros))
    lane, part = F.pmod(F.xxhash64("id", "v"), F.lit(lanes)).cast("int"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    rows = clean.select(lane.alias("lane"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "id", "v")
    queries = (
        clean.where("q").groupBy("id").agg(F.min("v").alias("v"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), part.alias("part"), "id", "v")
    )

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        query, row, ids = (_matrix(asked.column("v").combine_chunks(), width), _matrix(held.column("v").combine_chunks(), width), held.column("id").to_numpy())
        query_ids = asked.column("id").to_numpy()
        out = [np.zeros(0, np.int64)] * 3
        if len(query) and len(row):
            at, score, _ = best_of(query, query_ids, row, ids, k)
            hit = at >= 0
            out = [np.repeat(query_ids, hit.sum(axis=1)), ids[at[hit]], score[hit]]
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    found = queries.groupBy("lane", "part").cogroup(rows.groupBy("lane", "part")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
