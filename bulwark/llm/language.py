"""Language identification by interpolated Kneser-Ney character models, one for each language.

A text becomes letters and single spaces. A model scores it by its cross-entropy per character; the language with the
lowest wins, and a text that no model explains as well as the worst calibration text of its length is rejected.
N-grams are four 16-bit symbols in one 64-bit number, hashed by an odd factor (one to one) and kept in sorted arrays.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulwark.llm.words import pieces, utf8

ORDER = 4
SPACE = 32
#: What a text's cross-entropy may exceed the worst calibration text's by, in nats, before it is rejected.
MARGIN = 1.0
_HASH = np.uint64(0x9E3779B97F4A7C15)
_tables: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """Code point to symbol: the lower-case letter, 0 for what isn't a letter, 0xFFFF for letters above 0xFFFF."""
    if not _tables:
        t = np.zeros(0x110000, np.uint16)
        for c in range(0x30000):
            ch = chr(c)
            if unicodedata.category(ch)[0] == "L" or c in (0xAA, 0xBA):
                low = ord(ch.lower()[0])
                t[c] = low if low < 0xFFFF else 0xFFFF
        _tables.append(t)
    return _tables[0]


@dataclass
class Symbols:
    """Some neighbouring rows as symbols; `at` holds where each row's begin, and one more entry for the end."""

    symbols: np.ndarray
    at: np.ndarray
    letters: np.ndarray


def symbols(column: pa.Array) -> Iterator[Symbols]:
    """Letters lower-cased, every run of other characters one space; rows have no space at either end."""
    data, at = utf8(column)
    table = symbol_table()
    for i, j in pieces(at, 1 << 19):
        raw, a = data[at[i] : at[j]], at[i : j + 1] - at[i]
        chars = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        lead = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
        a = lead[a]
        s = table[chars]
        letter = s != 0
        first = np.zeros(len(s) + 1, bool)
        first[a] = True
        # A space stays if a letter of the same row is in front of it and one comes after it.
        before = np.concatenate(([False], letter[:-1])) & ~first[:-1] if len(s) else letter
        ranks = np.concatenate(([0], np.cumsum(letter)))
        row = np.repeat(np.arange(j - i), np.diff(a))
        later = ranks[a[1:]][row] > ranks[1:] if len(s) else letter
        keep = letter | (before & later)
        kept = np.concatenate(([0], np.cumsum(keep)))
        yield Symbols(np.where(letter, s, SPACE).astype(np.uint64)[keep], kept[a], ranks[a[1:]] - ranks[a[:-1]])


def grams(s: Symbols) -> np.ndarray:
    """For each symbol the four that end there, the oldest in the highest bits; spaces stand in front of a row."""
    n = len(s.symbols)
    out = s.symbols.copy()
    place = np.arange(n) - np.repeat(s.at[:-1], np.diff(s.at))
    for k in range(1, ORDER):
        back = np.full(n, SPACE, np.uint64)
        back[k:] = s.symbols[: n - k] if n > k else back[k:]
        out |= np.where(place >= k, back, np.uint64(SPACE)) << np.uint64(16 * k)
    return out


@dataclass
class Sorted:
    """Sorted hashes of n-grams, with where the hashes of each leading bit pattern begin."""

    keys: np.ndarray
    shift: int = 0
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    longest: int = 0

    @staticmethod
    def of(keys: np.ndarray) -> tuple[Sorted, np.ndarray]:
        hashed = keys * _HASH
        order = np.argsort(hashed)
        bits = max(1, min(22, int(len(keys)).bit_length() + 1))
        shift = 64 - bits
        starts = np.searchsorted(hashed[order] >> np.uint64(shift), np.arange((1 << bits) + 1, dtype=np.uint64))
        return Sorted(hashed[order], shift, starts, int(np.diff(starts).max(initial=0))), order

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in the sorted array, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        h = keys * _HASH
        lead = (h >> np.uint64(self.shift)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        last = len(self.keys) - 1
        out = np.where((at < end) & (self.keys[np.minimum(at, last)] == h), at, -1)
        for k in range(1, self.longest):
            open_ = np.flatnonzero((out < 0) & (at + k < end))
            if not len(open_):
                break
            hit = self.keys[at[open_] + k] == h[open_]
            out[open_[hit]] = at[open_[hit]] + k
        return out


@dataclass
class Model:
    """Log probabilities of n-grams of every order for every language, weights of contexts, and the calibration."""

    langs: list[str]
    tables: list[tuple[Sorted, np.ndarray]] = field(default_factory=list)
    weights: list[tuple[Sorted, np.ndarray]] = field(default_factory=list)
    unseen: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sharpness: float = 1.0
    limits: np.ndarray = field(default_factory=lambda: np.full(64, np.inf))

    def parts(self) -> dict:
        """Plain arrays, for broadcasting."""
        plain = [[(t.keys, t.shift, t.starts, t.longest, v) for t, v in x] for x in (self.tables, self.weights)]
        return {"langs": self.langs, "plain": plain, "rest": (self.unseen, self.sharpness, self.limits)}

    @staticmethod
    def of(parts: dict) -> Model:
        tables, weights = ([(Sorted(*x[:4]), x[4]) for x in side] for side in parts["plain"])
        return Model(parts["langs"], tables, weights, *parts["rest"])

    def logs(self, g: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram given the others, a column for each language."""
        out = np.zeros((len(g), len(self.langs)), np.float32)
        todo = np.arange(len(g))
        for n in range(ORDER, 0, -1):
            mask = np.uint64((1 << (16 * n)) - 1) if n < ORDER else np.uint64(0xFFFFFFFFFFFFFFFF)
            keys = g[todo] & mask
            table, logp = self.tables[n - 1]
            at = table.find(keys)
            hit = at >= 0
            out[todo[hit]] += logp[at[hit]]
            todo, keys = todo[~hit], keys[~hit]
            if not len(todo):
                return out
            contexts, weight = self.weights[n - 1]
            at = contexts.find(keys >> np.uint64(16))
            out[todo[at >= 0]] += weight[at[at >= 0]]
        out[todo] += self.unseen
        return out

    def entropies(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For some rows at a time: cross-entropy per symbol and language, symbols, letters. Rows without are 0."""
        for s in symbols(column):
            total = np.vstack((np.zeros((1, len(self.langs))), np.cumsum(-self.logs(grams(s)).astype(np.float64), axis=0)))
            n = np.diff(s.at)
            yield (total[s.at[1:]] - total[s.at[:-1]]) / np.maximum(n, 1)[:, None], n, s.letters

    def judge(self, column: pa.Array) -> tuple[list, list, list, list]:
        """lang (und without letters), score, best cross-entropy, rejected."""
        lang, score, best, rejected = [], [], [], []
        for x, n, letters in self.entropies(column):
            i = x.argmin(axis=1) if len(self.langs) else np.zeros(len(n), int)
            low = x.min(axis=1, initial=np.inf)
            odds = np.exp(-(x - low[:, None]) * self.sharpness * np.sqrt(n)[:, None]).sum(axis=1)
            und = (letters == 0) | (not self.langs)
            lang += ["und" if u else self.langs[k] for u, k in zip(und, i, strict=True)]
            score += np.where(und, 0.0, 1 / np.maximum(odds, 1)).tolist()
            best += [None if u else float(v) for u, v in zip(und, low, strict=True)]
            rejected += (und | (low > self.limits[_length_class(n)])).tolist()
        return lang, score, best, rejected


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(n, 1)).astype(int)


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from counts of four-symbol n-grams: lang is an index into langs."""
    model = Model(langs)
    width = len(langs)
    per_order: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in range(1, ORDER + 1)}
    for i in range(width):
        mine = lang == i
        g, c = gram[mine], count[mine].astype(np.float64)
        for n in range(ORDER, 0, -1):
            per_order[n].append((g, c))
            g, c = np.unique(g & np.uint64((1 << (16 * (n - 1))) - 1), return_counts=True)  # in how many contexts
            c = c.astype(np.float64)
    alphabet = len(np.unique(np.concatenate([g for g, _ in per_order[1]]))) if width else 0
    lower, model.unseen = None, np.zeros(width, np.float32)
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([g for g, _ in per_order[n]])) if width else np.zeros(0, np.uint64)
        contexts = np.unique(keys >> np.uint64(16))
        p, w = np.zeros((len(keys), width)), np.ones((len(contexts), width))
        where = np.searchsorted(contexts, keys >> np.uint64(16))
        if n == 1:
            base = np.full((len(keys), width), 1 / (alphabet + 1))
        else:
            below = lower[0]
            base = lower[1][np.searchsorted(below, keys & np.uint64((1 << (16 * (n - 1))) - 1))]
        for i, (g, c) in enumerate(per_order[n]):
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            context = np.searchsorted(contexts, g >> np.uint64(16))
            total = np.bincount(context, c, len(contexts))
            kinds = np.bincount(context, minlength=len(contexts))
            seen = total > 0
            w[seen, i] = d * kinds[seen] / total[seen]
            at = np.searchsorted(keys, g)
            p[at, i] = np.maximum(c - d, 0) / total[context]
        p += w[where] * base
        lower = (keys, p)
        table, order = Sorted.of(keys)
        model.tables.append((table, np.log(p[order]).astype(np.float32)))
        table, order = Sorted.of(contexts)
        model.weights.append((table, np.log(w[order]).astype(np.float32)))
        if n == 1:
            model.unseen = np.full(width, -np.log(alphabet + 1), np.float32)
    return model


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int = 8000, calibration: int = 10) -> Model:
    """Fit on a bounded sample of labelled rows: `max_rows` whole texts (expected), drawn by a hash of the id, as
    many of each language as its share, but of languages with fewer than max_rows / (4 * languages) rows all.

    One in `calibration` of them is kept out of the counts; it sets how sharp scores are and the limits of
    rejection. Null languages and null texts are left out. N-grams are counted in Spark.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return build([], np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0))
    total = sum(sizes.values())
    share = {x: min(1.0, max(max_rows / total, max_rows / (4 * len(langs) * sizes[x]))) for x in langs}
    drawn = F.pmod(F.xxhash64("id", F.lit(71)), F.lit(1_000_000))
    limit = F.coalesce(*[F.when(F.col("lang") == x, F.lit(int(share[x] * 1_000_000))) for x in langs])
    held = F.pmod(F.xxhash64("id", F.lit(72)), F.lit(calibration)) == 0
    rows = rows.where(drawn < limit).withColumn("held", held)
    index = {x: i for i, x in enumerate(langs)}

    def count(batches):
        for b in batches:
            labels = np.array([index[x] for x in b.column(1).to_pylist()], np.int64)
            row, found = 0, []
            for s in symbols(b.column(0)):
                g = grams(s)
                of = np.repeat(labels[row : row + len(s.at) - 1], np.diff(s.at))
                row += len(s.at) - 1
                for i in np.unique(of):
                    k, c = np.unique(g[of == i], return_counts=True)
                    found.append((np.full(len(k), i), k, c))
            if found:
                parts = [np.concatenate(x) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[0], pa.int32()), pa.array(parts[1].view(np.int64)), pa.array(parts[2], pa.int64())],
                    ["lang", "gram", "n"],
                )

    counts = (
        rows.where("not held").select("text", "lang").mapInArrow(count, "lang int, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    columns = [counts.column(c).to_numpy() for c in ("lang", "gram", "n")]
    order = np.lexsort((columns[1], columns[0]))
    lang, gram, n = (c[order] for c in columns)
    model = build(langs, lang, gram.view(np.uint64), n)
    calibrate(model, rows.where("held").select("text", "lang"))
    return model


def calibrate(model: Model, held: DataFrame) -> None:
    """Sharpness by likelihood of the true languages; limits: the worst text of its length class or a longer one."""
    index = {x: i for i, x in enumerate(model.langs)}
    shared = held.sparkSession.sparkContext.broadcast(model.parts())

    def measure(batches):
        m = Model.of(shared.value)
        for b in batches:
            truth = [index[x] for x in b.column(1).to_pylist()]
            x, n, letters = (np.concatenate(p) for p in zip(*m.entropies(b.column(0)), strict=True))
            ok = letters > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[ok].tolist(), pa.list_(pa.float64())), pa.array(n[ok]), pa.array(np.array(truth)[ok], pa.int64())],
                ["x", "n", "truth"],
            )

    rows = held.mapInArrow(measure, "x array<double>, n long, truth long").toArrow()
    if not rows.num_rows:
        return
    x = np.array(rows.column("x").to_pylist())
    n, truth = rows.column("n").to_numpy(), rows.column("truth").to_numpy()
    own = x[np.arange(len(x)), truth]
    best, model.sharpness = np.inf, 1.0
    for t in 2.0 ** np.arange(-4, 6):
        z = -(x - x.min(axis=1)[:, None]) * t * np.sqrt(n)[:, None]
        loss = (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(x)), truth]).sum()
        if loss < best - 1e-6:
            best, model.sharpness = loss, float(t)
    worst = np.full(64, -np.inf)
    np.maximum.at(worst, _length_class(n), own)
    worst = np.maximum.accumulate(worst[::-1])[::-1]
    # A class longer than any calibration text takes the limit of the longest one; all get a margin.
    longest = worst[np.isfinite(worst)].min()
    model.limits = np.where(np.isfinite(worst), worst, longest) + MARGIN


def identify(docs: DataFrame, text_col: str, model: Model) -> DataFrame:
    """Add lang_pred, score (0 to 1), cross_entropy and rejected to every row; nothing is shuffled.

    Defined cases: null texts and texts without a letter are `und` with score 0 and are rejected; an empty model
    (no labelled rows) predicts `und`; input columns with these names are replaced.
    """
    added = ["lang_pred", "score", "cross_entropy", "rejected"]
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in added])
    if text_col not in docs.columns:
        raise ValueError(f"no column {text_col}")
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    types = ("string", "double", "double", "boolean")
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in zip(added, types, strict=True):
        schema = schema.add(name, kind)
    position = docs.columns.index(text_col)

    def run(batches):
        m = Model.of(shared.value)
        for b in batches:
            lang, score, best, rejected = m.judge(b.column(position))
            more = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(best, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *added])

    return docs.mapInArrow(run, schema)
