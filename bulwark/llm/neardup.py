"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation, components.

1. One pass over the texts cuts words, hashes shingles and keeps, for each document, its set size, a digest of the
   set, and a signature. Documents with equal sets form a class; only its smallest id goes on.
2. Bands of the signature propose candidates. A bucket is never expanded into all its pairs. Each class first meets
   the best-connected class among its buckets. Links found so form components. Where classes of several components
   share a bucket, all but the largest component's are compared with the rest, tile by tile inside tasks; what is
   sent on is classes and one link for each class and component, never pairs.
3. A candidate pair is judged by batches of its signature: it is dropped as soon as the posterior probability that
   its similarity reaches the threshold falls below `miss`. Survivors are confirmed on their full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulwark.llm.words import NONSPACE, cut, mix
from bulwark.session import checkpointed

BANDS, ROWS = 30, 5
HASHES = BANDS * ROWS
BATCH = 30

_rng = np.random.RandomState(13)
_A = _rng.randint(0, 2**31, HASHES).astype(np.uint32) * 2 + 1
_B = _rng.randint(0, 2**31, HASHES).astype(np.uint32) * 2 + 1
_SECOND = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted: `width` neighbouring words, or all words if there are fewer."""
    for words in cut(column, NONSPACE):
        h = words.hashes
        joined = h.copy()
        for k in range(1, min(width, len(h))):
            joined[: len(h) - k] = mix(joined[: len(h) - k] * _SECOND + h[k:])
        for i, j in zip(words.word_at[:-1].tolist(), words.word_at[1:].tolist(), strict=True):
            if j - i >= width:
                s = np.sort(joined[i : j - width + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif j > i:
                one = h[i]
                for k in range(i + 1, j):
                    one = mix(one[None] * _SECOND + h[k])[0]
                yield np.array([one], np.uint64)
            else:
                yield h[:0]


def signature(s: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    low, high = (s & np.uint64(0xFFFFFFFF)).astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(s), 1024):
        x = low[i : i + 1024, None] * _A
        x += high[i : i + 1024, None] * _B
        np.minimum(least, x.min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of a 16-bit signature; the band number is part of it."""
    rows = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mix(key * _SECOND + rows[:, :, r] + np.uint64(1))
    return key


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Per row (id, text): id, a hash of the text, set size, digest of the set, the low 16 bits of each signature hash and the band keys made of them."""

    def run(batches):
        for b in batches:
            n, digest, sig, bands = [], [], [], []
            for s in shingle_sets(b.column(1), width):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                least = signature(s).astype(np.uint16) if len(s) else None
                sig.append(None if least is None else least.tobytes())
                bands.append(None if least is None else band_keys(least)[0].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["id", "h", "n", "digest", "sig", "bands"],
            )

    return docs.select("id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, "id long, h long, n long, digest binary, sig binary, bands array<bigint>"
    )


def needed_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """For each batch end n, the fewest matches m with P(similarity >= threshold | m of n) >= miss.

    Uniform prior. The posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
        out.append((n, m))
    return out


def plausible(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Candidate pairs (a, b) that no batch of the signatures rules out."""
    steps = needed_matches(threshold, miss)

    def run(batches):
        for t in batches:
            left, right = (_matrix(t.column(i)) for i in (2, 3))
            alive = np.arange(t.num_rows)
            matches = np.zeros(t.num_rows, np.int32)
            done = 0
            for n, least in steps:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1, dtype=np.int32)
                alive, done = alive[matches[alive] >= least], n
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays([t.column(0).take(kept), t.column(1).take(kept)], ["a", "b"])

    return (
        pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(run, "a long, b long")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros((0, HASHES), np.uint16)
    return np.frombuffer(column.buffers()[2], np.uint16)[at[0] // 2 : at[-1] // 2].reshape(-1, HASHES)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets satisfy 100 * intersection >= percent * union. texts: id, text."""

    def run(batches):
        for t in batches:
            last_text, last_set, keep = None, None, []
            for i, s in enumerate(shingle_sets(t.column(3), width)):
                one = t.column(2)[i].as_py()
                if one != last_text:
                    last_text, last_set = one, next(shingle_sets(pa.array([one]), width))
                both = len(np.intersect1d(last_set, s, assume_unique=True))
                if 100 * both >= percent * (len(last_set) + len(s) - both):
                    keep.append(i)
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([t.column(0).take(kept), t.column(1).take(kept)], ["a", "b"])

    # One side of most pairs is a class that many others meet: its rows come together, so its set is made once.
    return (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a long, b long")
    )


TILE_A, TILE_B = 128, 512


def tiles(mixed: DataFrame) -> DataFrame:
    """Deal buckets into tiles: side 0 holds classes outside the bucket's main component, side 1 all classes.

    mixed: band, place, size, id, n, root, main, others. A tile has about TILE_A and TILE_B classes, so a bucket of
    any size is many small tasks.
    """
    of = lambda n, most: F.ceil(n / F.lit(most)).cast("int")
    a, b = of(F.col("others"), TILE_A), of(F.col("size"), TILE_B)
    mine = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    all_of = lambda n: F.sequence(F.lit(0), n - 1)
    keep = ["band", "place", "id", "n", "root"]
    left = mixed.where("root <> main").select(*keep, mine(a, 1).alias("ta"), F.explode(all_of(b)).alias("tb"), F.lit(0).alias("side"))
    right = mixed.select(*keep, F.explode(all_of(a)).alias("ta"), mine(b, 2).alias("tb"), F.lit(1).alias("side"))
    return left.unionByName(right)


def tile_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows sorted by (band, ta, tb, side) as one table for each tile, with the rows of side 0 and of side 1."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        keys = np.stack([t.column(i).to_numpy() for i in range(3)], axis=1)
        if not len(keys):
            continue
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *edges.tolist(), len(keys)]
        for i, j in zip(edges, edges[1:]):
            key = tuple(keys[i].tolist())
            if key != last and held:
                yield from _tile(held)
                held = []
            held.append(t.slice(i, j - i))
            last = key
    if held:
        yield from _tile(held)


def _tile(held: list[pa.Table]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    t = (held[0] if len(held) == 1 else pa.concat_tables(held)).combine_chunks()
    side = t.column("side").to_numpy()
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(a) and len(b):
        yield t, a, b


_TILE = "band long, ta int, tb int, side int, id long, n long, root long"


def plausible_tiles(rows: DataFrame, threshold: float, miss: float, percent: int) -> DataFrame:
    """Rows of a tile that some pair of the tile still needs: different components, sizes that allow the threshold,
    no band shared before this one, and no batch of the signatures that rules the pair out."""
    steps = needed_matches(threshold, miss)
    names = ["band", "ta", "tb", "side", "id", "n", "root"]

    def run(batches):
        for t, a, b in tile_groups(batches):
            sig, n, root = _matrix(t.column("sig").chunk(0)), t.column("n").to_numpy(), t.column("root").to_numpy()
            place = int(t.column("place")[0].as_py())
            least, most = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
            ia, ib = np.nonzero((root[a][:, None] != root[b]) & (least * 100 >= most * percent))
            needed = np.zeros(t.num_rows, bool)
            for i in range(0, len(ia), 20_000):
                x, y = a[ia[i : i + 20_000]], b[ib[i : i + 20_000]]
                matches, done = np.zeros(len(x), np.int32), 0
                for end, fewest in steps:
                    matches += (sig[x, done:end] == sig[y, done:end]).sum(axis=1, dtype=np.int32)
                    alive, done = matches >= fewest, end
                    x, y, matches = x[alive], y[alive], matches[alive]
                for band in range(place):
                    at = slice(band * ROWS, (band + 1) * ROWS)
                    alive = (sig[x, at] != sig[y, at]).any(axis=1)
                    x, y = x[alive], y[alive]
                needed[x] = needed[y] = True
            if needed.any():
                kept = t.select(names).take(pa.array(np.flatnonzero(needed)))
                yield from kept.combine_chunks().to_batches()

    rows = rows.select("band", "ta", "tb", "side", "id", "n", "root", "place", "sig")
    return rows.repartition("band", "ta", "tb").sortWithinPartitions("band", "ta", "tb", "side").mapInArrow(run, _TILE)


def exact_tiles(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) inside tiles, confirmed on full sets: for each class of side 0 one link to each component."""

    def run(batches):
        for t, a, b in tile_groups(batches):
            sets = list(shingle_sets(t.column("text").chunk(0), width))
            n, root, ids = np.array([len(s) for s in sets]), t.column("root").to_numpy(), t.column("id").to_numpy()
            order = b[np.argsort(root[b], kind="stable")]
            order = order[n[order] > 0]
            if not len(order):
                continue
            held, codes = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
            at = np.concatenate(([0], np.cumsum(n[order])))[:-1]
            links = []
            for x in a.tolist():
                place = np.searchsorted(held, sets[x])
                hit = held[np.minimum(place, len(held) - 1)] == sets[x]
                mark = np.zeros(len(held), np.int32)
                mark[place[hit]] = 1
                both = np.add.reduceat(mark[codes], at)
                found = order[(100 * both >= percent * (n[x] + n[order] - both)) & (root[order] != root[x])]
                if len(found):
                    found = found[np.unique(root[found], return_index=True)[1]]
                    links += [(int(ids[x]), int(y)) for y in ids[found]]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    rows = rows.join(texts, "id").select("band", "ta", "tb", "side", "id", "n", "root", "text")
    return rows.repartition("band", "ta", "tb").sortWithinPartitions("band", "ta", "tb", "side").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, root): for every id in `links` (a, b) the smallest id it is connected with.

    Every id points to its smallest neighbour or itself, pointers are shortened until they reach a root, and links
    between roots go into the next pass. Minima are combined before each shuffle, so a hub costs one row per task.
    """
    edges = checkpointed(links.where("a <> b").select("a", "b"))
    known = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("root")))
        while True:
            up = points.where("id <> root").select(F.col("id").alias("root"), F.col("root").alias("further"))
            shorter = checkpointed(points.join(up, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
            points = shorter.select("id", "root")
            if shorter.where("moved").isEmpty():
                break
        a, b = (points.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        edges = checkpointed(
            edges.join(a, "a").join(b, "b").where("root_a <> root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
        )
        if known is None:
            known = points
        else:
            further = points.select(F.col("id").alias("root"), F.col("root").alias("further"))
            known = checkpointed(known.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root")))
    return known if known is not None else links.select(F.col("a").alias("id"), F.col("a").alias("root")).limit(0)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    miss: float = 1e-7,
) -> DataFrame:
    """Per row of docs: id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest id connected with the row's. Words are what stands between white space, A-Z lower-cased. A pair of
    exactly 80 % similarity shares none of the 30 bands of 5 hashes with probability 7e-6; a verified pair is lost
    with probability about `miss` per batch. Nothing is capped or sampled.
    Defined cases: a text that is null or has no words has no shingles and is linked with nothing; rows of equal
    texts share a class; rows that share an id count as one document (linked); rows without an id link others but
    get the component of their class, null if the class has no id, and kept is then true; columns besides id and
    text are not read; an empty table gives an empty result.
    """
    found = judged(docs, id_col, text_col, width, percent, miss)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def judged(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, miss: float = 1e-7) -> DataFrame:
    """near_duplicates with a hash of each row's text: id, h, n, digest, component_id, kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = checkpointed(sketches(docs, width))
    classes = rows.where("digest is not null").groupBy("digest").agg(F.min("id").alias("id"))
    narrow = rows.select("id", "h", "n", "digest")
    # The smallest id's own row holds its class's signature; rows that repeat an id and a set are alike.
    chosen = rows.join(classes.where("id is not null"), ["digest", "id"], "left_semi").groupBy("digest", "id")
    reps = checkpointed(chosen.agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    sigs = reps.select("id", "sig")
    threshold = percent / 100

    # Buckets of two classes or more, and how much company each class has in all.
    spread = reps.select("id", "n", F.posexplode("bands").alias("place", "band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = checkpointed(spread.join(shared, "band"))
    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    members_of = members.join(company, "id")
    best = members_of.groupBy("band").agg(F.max(F.struct("company", (-F.col("id")).alias("i"), "n")).alias("best"))
    first = (
        members_of.join(best, "band")
        .select("id", F.struct(F.col("best.company").alias("company"), F.col("best.i").alias("i")).alias("best"))
        .groupBy("id")
        .agg(F.max("best").alias("best"))
        .select((-F.col("best.i")).alias("a"), F.col("id").alias("b"))
        .where("a <> b")
    )
    involved = members.select("id").distinct()
    texts = checkpointed(docs.join(involved, "id", "left_semi").groupBy("id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("id", "text"))
    links = checkpointed(confirmed(plausible(first, sigs, threshold, miss), texts, width, percent))
    comps = components(links)

    # Buckets in which components meet: all but the largest component's classes against every class.
    in_comp = checkpointed(members.join(comps, "id", "left").select("band", "place", "size", "id", "n", F.coalesce("root", "id").alias("root")))
    meet = in_comp.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    largest = in_comp.join(meet, "band").groupBy("band", "root").agg(F.count("*").alias("c")).groupBy("band")
    largest = largest.agg(F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("c"))
    mixed = in_comp.join(largest.select("band", F.col("m.root").alias("main"), (F.col("c") - F.col("m.c")).alias("others")), "band")
    more = exact_tiles(plausible_tiles(tiles(mixed).join(sigs, "id"), threshold, miss, percent), texts, width, percent)
    linked = links.unionByName(more)
    # Rows that share an id tie their classes together: both carry that id, so no link is needed for them.
    roots = components(linked)
    by_class = reps.select("digest", "id").join(roots, "id", "left").select("digest", F.coalesce("root", "id").alias("root"))
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("root"))
    found = narrow.join(by_class, "digest", "left").withColumn("component_id", component)
    return found.withColumn("kept", F.col("component_id").eqNullSafe(F.col("id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is its component's smallest id; of rows alike in id and text, one.

    Rows without an id stay if no document with an id is connected with them. Input columns are untouched.
    """
    kept = judged(docs, id_col, text_col, width, percent).where("kept").groupBy("id", "h").agg(F.count("*").alias("n"))
    kept = checkpointed(kept.select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("n").alias("__n")))
    same = docs[id_col].cast("long").eqNullSafe(kept["__id"]) & (F.xxhash64(docs[text_col]) == kept["__h"])
    once, often = (docs.join(kept.where(which), same, "left_semi") for which in ("__n = 1", "__n > 1"))
    # Only rows that repeat an id and a hash of the text move once more.
    return once.unionByName(often.dropDuplicates([id_col, text_col]))
