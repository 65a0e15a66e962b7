"""Whitening of embeddings by the exact characteristic polynomial of their scatter matrix.

Entries become integers, so the scatter matrix of the distinct vectors is one of exact integers. Its characteristic
polynomial is found modulo many primes, each by reduction to Hessenberg form in a task of its own, and put together
by the Chinese remainder theorem. All its roots are real, so sign changes of the shifted polynomial count the roots
beyond any point; that isolates the largest ones, which bisection narrows to hundreds of bits. Inverse iteration at
such a root, in decimals of the same precision and a task for each root, gives its null space: the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulwark.session import scratch_path

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries from here on count as not finite: a double no longer holds each whole number.
LARGEST = 2**52
#: Rows multiplied at once: 2**13 products of 36 bits fit a double.
CHUNK_ROWS = 1 << 13
LIMB = 18
#: Relative precision of the roots in bits, beyond what it takes to tell them apart.
ROOT_BITS = 200

Poly = list[int]  # coefficients from the constant term up


# Integer sums over tables


def quantised(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry, as longs; null if the vector or an entry is null, not finite or too large."""
    entry = lambda v: v.cast("double") * scale
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(entry(v)) >= float(LARGEST)))
    return F.when(~bad, F.transform(vector, lambda v: F.floor(entry(v)) + shift))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows of `width` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def exact_gram(z: np.ndarray) -> np.ndarray:
    """z.T @ z as Python integers, whatever their size: limbs of 18 bits are multiplied in doubles without loss."""
    out = np.zeros((z.shape[1], z.shape[1]), object)
    for a in range(0, len(z), CHUNK_ROWS):
        part = z[a : a + CHUNK_ROWS]
        limbs, shift = [], 0
        while True:
            if int(np.abs(part).max(initial=0)) < 1 << LIMB:
                limbs.append((shift, part.astype(np.float64)))
                break
            limbs.append((shift, (part & ((1 << LIMB) - 1)).astype(np.float64)))
            part, shift = part >> LIMB, shift + LIMB
        for s, x in limbs:
            for t, y in limbs:
                out += np.array((x.T @ y).astype(np.int64), object) << (s + t)
    return out


def total(vectors: DataFrame, width: int, part) -> dict[tuple[int, int], int]:
    """Sum over all vectors of part(matrix), which gives exact integers by (i, j): one row of each pair and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        for b in batches:
            for key, value in part(matrix(b.column("x"), width)).items():
                sums[key] = sums.get(key, 0) + value
        if sums:
            i, j = zip(*sums, strict=True)
            value = pa.array([Decimal(v) for v in sums.values()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), value], ["i", "j", "value"])

    found = vectors.select("x").mapInArrow(run, "i int, j int, value decimal(38,0)").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r["i"], r["j"]): int(r["value"]) for r in found.collect()}  # at most width squared


def scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S, and the matrix n * sum(z z') - sum(z) sum(z)' for z = x less the rounded mean: n**2 times the covariance."""
    n = vectors.count()
    sums = total(vectors, width, lambda x: {(i, 0): int(v) for i, v in enumerate(_column_sums(x))})
    s = [sums.get((i, 0), 0) for i in range(width)]
    centre = np.array([(2 * v + n) // (2 * n) if n else 0 for v in s], np.int64)

    def part(x: np.ndarray) -> dict[tuple[int, int], int]:
        gram = exact_gram(x - centre)
        return {(i, j): int(gram[i, j]) for i in range(width) for j in range(i, width)}

    held = total(vectors, width, part)
    rest = [v - n * int(c) for v, c in zip(s, centre, strict=True)]
    m = np.zeros((width, width), object)
    for i in range(width):
        for j in range(i, width):
            m[i, j] = m[j, i] = n * held.get((i, j), 0) - rest[i] * rest[j]
    return n, s, m


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact: halves of 32 bits are summed apart."""
    low, high = x & 0xFFFFFFFF, x >> 32
    return np.array(low.sum(axis=0), object) + (np.array(high.sum(axis=0), object) << 32)


# The characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2**32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    r = ((n - 1) & (1 - n)).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, (n - 1) >> r, n)
        if x != 1 and all((x := x if i == 0 else x * x % n) != n - 1 for i in range(r)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes from 2**31 down whose product exceeds the bound, and one more to check the result with."""
    out, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    while not is_prime(n):
        n -= 2
    return [*out, n]


def hessenberg(m: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """The matrix modulo each prime (first axis), brought to Hessenberg form by similarity."""
    p = primes[:, None, None]
    h = np.stack([(m % int(q)).astype(np.int64) for q in primes])
    every, d = np.arange(len(primes)), h.shape[1]
    for c in range(1, d - 1):
        pivot = c + (h[:, c:, c - 1] != 0).argmax(axis=1)
        h[every, pivot], h[every, c] = h[every, c], h[every, pivot]
        h[every, :, pivot], h[every, :, c] = h[every, :, c], h[every, :, pivot]
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(h[:, c, c - 1], primes, strict=True)])
        u = h[:, c + 1 :, c - 1] * inverse[:, None] % primes[:, None]
        h[:, c + 1 :] = (h[:, c + 1 :] - u[:, :, None] * h[:, c][:, None, :] % p) % p
        h[:, :, c] = (h[:, :, c] + (h[:, :, c + 1 :] * u[:, None, :] % p).sum(axis=2)) % primes[:, None]
    return h


def polynomials(m: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients, from the constant term up, of det(xI - m) modulo each prime, by the recurrence over leading blocks."""
    h, q, d = hessenberg(m, primes), primes[:, None], m.shape[0]
    done = [np.zeros((len(primes), d + 1), np.int64)]
    done[0][:, 0] = 1
    for k in range(d):
        new = np.roll(done[k], 1, axis=1) - h[:, k, k][:, None] * done[k] % q
        below = np.ones(len(primes), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % primes
            new -= (h[:, i, k] * below % primes)[:, None] * done[i] % q
        done.append(new % q)
    return done[d]


def remaindered(residues: dict[int, list[int]]) -> Poly:
    """The integers of least size with the given residues by prime."""
    product = math.prod(residues)
    out = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        part = product // p
        unit = part * pow(part, -1, p)
        out = [a + v * unit for a, v in zip(out, values, strict=True)]
    return [v - product if 2 * (v := a % product) > product else v for a in out]


def characteristic(spark: SparkSession, m: np.ndarray) -> Poly:
    """det(xI - m) of a positive semidefinite integer matrix; primes are dealt over tasks."""
    d, trace = m.shape[0], int(sum(m.diagonal()))
    # Sums of k-fold products of roots are largest if all roots are the mean (Maclaurin).
    bound = 2 * max(comb(d, k) * -(-(trace**k) // d**k) for k in range(d + 1))
    primes = primes_beyond(bound)
    shared = spark.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine = b.column(0).to_numpy()
            if len(mine):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(polynomials(shared.value, mine).tolist(), pa.list_(pa.int64()))], ["p", "c"])

    rows = spark.createDataFrame([(p,) for p in primes], "p long")
    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    found = {r["p"]: r["c"] for r in rows.repartition(tasks).mapInArrow(run, "p long, c array<bigint>").collect()}
    check = found.pop(primes[-1])
    out = remaindered(found)
    if [c % primes[-1] for c in out] != check:
        raise ArithmeticError("the polynomial fails its check modulo a further prime")
    return out


# Its roots


def divided(a: Poly, b: Poly) -> tuple[Poly, Poly]:
    """Quotient and remainder by a monic b."""
    rest, out = list(a), [0] * max(1, len(a) - len(b) + 1)
    for k in range(len(a) - len(b), -1, -1):
        out[k] = c = rest[k + len(b) - 1]
        for i, v in enumerate(b):
            rest[k + i] -= c * v
    return out, rest[: len(b) - 1]


def gcd_modulo(a: Poly, b: Poly, p: int) -> Poly:
    """Monic greatest common divisor modulo p."""
    a, b = ([c % p for c in x] for x in (a, b))
    while True:
        while b and not b[-1]:
            b.pop()
        if not b:
            unit = pow(a[-1], -1, p)
            return [c * unit % p for c in a]
        unit = pow(b[-1], -1, p)
        b = [c * unit % p for c in b]
        a, b = b, [c % p for c in divided(a, b)[1]] if len(a) >= len(b) else a


def common(a: Poly, b: Poly) -> Poly:
    """The monic greatest common divisor of a monic polynomial and another, from its images modulo primes."""
    images: dict[int, Poly] = {}
    n, last = 2**31 - 1, None
    while True:
        if is_prime(n) and any(c % n for c in b):
            g = gcd_modulo(a, b, n)
            if len(g) == 1:
                return [1]
            least = min((len(x) for x in images.values()), default=len(g))
            if len(g) <= least:
                images = {p: x for p, x in images.items() if len(x) == len(g)} | {n: g}
                now = remaindered(images)
                if now == last and not any(divided(a, now)[1]) and not any(divided(b, now)[1]):
                    return now
                last = now
        n -= 2


def by_multiplicity(f: Poly) -> list[tuple[int, Poly]]:
    """(m, factor): the roots of the factor, each simple in it, are those of f with multiplicity m."""
    repeated = common(f, [k * c for k, c in enumerate(f)][1:] or [0]) if len(f) > 2 else [1]
    simple, out, m = divided(f, repeated)[0], [], 1
    while len(simple) > 1:
        both = common(simple, repeated) if len(repeated) > 1 else [1]
        factor = divided(simple, both)[0]
        if len(factor) > 1:
            out.append((m, factor))
        simple, repeated, m = both, divided(repeated, both)[0], m + 1
    return out


def roots_beyond(f: Poly, a: int, bits: int) -> int:
    """How many roots of f, all of which are real, exceed a / 2**bits: sign changes of f(x + a / 2**bits)."""
    d = len(f) - 1
    c = [v << (bits * (d - k)) for k, v in enumerate(f)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def sign_at(f: Poly, a: int, bits: int) -> int:
    value = 0
    for k, c in enumerate(reversed(f)):
        value = value * a + (c << (bits * k))
    return (value > 0) - (value < 0)


def largest_roots(f: Poly, count: int, upto: int) -> list[tuple[int, int, int]]:
    """(a, b, bits): the `count` largest positive roots of f, each alone in (a, b] / 2**bits. Roots are simple, real and below upto."""
    top = 1 << upto.bit_length()
    open_, out = [(0, top, 0, roots_beyond(f, 0, 0), 0)], []
    while open_ and len(out) < count:
        a, b, bits, beyond_a, beyond_b = open_.pop()
        if beyond_a == beyond_b:
            continue
        if beyond_a - beyond_b == 1:
            out.append((a, b, bits))
            continue
        if b - a == 1:
            a, b, bits = 2 * a, 2 * b, bits + 1
        middle = (a + b) // 2
        inside = roots_beyond(f, middle, bits)
        open_ += [(a, middle, bits, beyond_a, inside), (middle, b, bits, inside, beyond_b)]
    return out


def narrowed(f: Poly, a: int, b: int, bits: int, width: Fraction) -> tuple[int, int]:
    """The root in (a, b] / 2**bits to within the width, as (numerator, bits)."""
    at_b = sign_at(f, b, bits)
    while at_b and Fraction(b - a, 1 << bits) > width:
        if b - a == 1:
            a, b, bits = 2 * a, 2 * b, bits + 1
        middle = (a + b) // 2
        sign = sign_at(f, middle, bits)
        if sign == 0:
            return middle, bits
        a, b = (a, middle) if sign == at_b else (middle, b)
    return (b, bits) if not at_b else (a + b, bits + 1)


# Its components


def null_space(m: np.ndarray, root: Fraction, size: int, digits: int) -> np.ndarray:
    """`size` orthonormal vectors v with m v = root v, by inverse iteration in decimals."""
    with localcontext() as context:
        context.prec = digits
        d = m.shape[0]
        value = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(int(v)) for v in row] for row in m], object)
        a[np.arange(d), np.arange(d)] -= value
        tiny = max((abs(v) for v in a.flat), default=Decimal(1)) * Decimal(10) ** (-digits * 3 // 4)
        tiny = tiny or Decimal(1)
        order = np.arange(d)
        for c in range(d):
            pivot = c + max(range(d - c), key=lambda i: abs(a[c + i, c]))
            a[[c, pivot]], order[[c, pivot]] = a[[pivot, c]], order[[pivot, c]]
            if abs(a[c, c]) < tiny:
                a[c, c] = tiny
            a[c + 1 :, c] = a[c + 1 :, c] / a[c, c]
            a[c + 1 :, c + 1 :] -= np.multiply.outer(a[c + 1 :, c], a[c, c + 1 :])
        state = np.random.RandomState(11)
        found = [np.array([Decimal(int(v)) for v in state.randint(1, 1 << 20, d)], object) for _ in range(size)]
        for _ in range(4):
            for j in range(size):
                v = found[j][order]
                for c in range(d):
                    v[c + 1 :] -= a[c + 1 :, c] * v[c]
                for c in range(d - 1, -1, -1):
                    v[c] = (v[c] - (a[c, c + 1 :] * v[c + 1 :]).sum()) / a[c, c] if c < d - 1 else v[c] / a[c, c]
                v = v / max(abs(x) for x in v)
                for other in found[:j]:
                    v = v - other * (other * v).sum()
                found[j] = v / (v * v).sum().sqrt()
        return np.array([[float(x) for x in v] for v in found])


@dataclass
class Basis:
    """What the fit list says: n, sums, and for each component its unit vector, eigenvalue and share of the trace."""

    n: int
    width: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: list[float]
    shares: list[float]


def components(spark: SparkSession, m: np.ndarray, count: int) -> list[tuple[Fraction, np.ndarray]]:
    """The `count` largest positive eigenvalues of a positive semidefinite integer matrix, with unit eigenvectors."""
    trace = int(sum(m.diagonal()))
    if not trace:
        return []
    f = characteristic(spark, m)
    zeros = next(k for k, c in enumerate(f) if c)
    isolated = [(mult, g, *r) for mult, g in by_multiplicity(f[zeros:]) for r in largest_roots(g, count, trace)]
    deepest = max(trace.bit_length() + bits for _, _, _, _, bits in isolated)
    apart = min((Fraction(b - a, 1 << bits) for _, _, a, b, bits in isolated), default=Fraction(1))
    # Two factors' intervals may still overlap, so all are first narrowed well below the gaps seen.
    precision = ROOT_BITS + 2 * deepest + max(0, (trace / apart).__ceil__().bit_length())
    roots = []
    for mult, g, a, b, bits in isolated:
        at, scale = narrowed(g, a, b, bits, Fraction(trace, 1 << precision))
        roots.append((Fraction(at, 1 << scale), mult))
    roots.sort(reverse=True)
    wanted, have = [], 0
    for root, mult in roots:
        if have < count:
            wanted.append((root, mult))
            have += mult
    digits = int(precision * 0.30103) + 30
    shared = spark.sparkContext.broadcast((m, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, vectors = [], []
            for i in b.column(0).to_pylist():
                found = null_space(shared.value[0], *shared.value[1][i], digits)
                at += [i] * len(found)
                vectors += found.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], ["root", "v"])

    rows = spark.range(0, len(wanted), 1, len(wanted)).mapInArrow(run, "root long, v array<double>").collect()
    rows.sort(key=lambda r: r["root"])
    return [(wanted[r["root"]][0], np.array(r["v"])) for r in rows][:count]


def fitted(vectors: DataFrame, width: int, count: int = 16) -> Basis:
    """Fit on a table of vectors `x` of whole numbers, each taken as it is; at most `count` components of positive variance."""
    spark = vectors.sparkSession
    n, sums, m = scatter(vectors, width)
    divisor = math.gcd(*(int(v) for v in m.flat)) if width else 0
    found = components(spark, m // divisor, count) if divisor else []
    trace = int(sum(m.diagonal())) if width else 0
    values = [root * divisor for root, _ in found]
    return Basis(
        n, width, sums, np.array([v for _, v in found]).reshape(len(found), width),
        [float(v / n**2) for v in values], [float(v / trace) for v in values],
    )


def centred(x: np.ndarray, basis: Basis) -> np.ndarray:
    """n * x - S, exactly: as longs, or as Python integers where longs are too small."""
    mean = [(2 * s + basis.n) // (2 * basis.n) for s in basis.sums]
    z, rest = x - np.array(mean, np.int64), np.array([basis.n * c - s for c, s in zip(mean, basis.sums, strict=True)], object)
    largest = (int(np.abs(z).max(initial=0)) + 1) * basis.n
    return basis.n * z + rest.astype(np.int64) if largest < 2**62 else basis.n * z.astype(object) + rest


def projected(y: np.ndarray, basis: Basis) -> np.ndarray:
    return y.astype(np.float64) @ basis.vectors.T / (basis.n * np.sqrt(np.array(basis.eigenvalues)))


def identity_error(vectors: DataFrame, basis: Basis) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(basis.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k))
        for b in batches:
            w = projected(centred(matrix(b.column("x"), basis.width), basis), basis)
            sums += np.concatenate((w.T @ w, w.sum(axis=0)[None]))
        i, j = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(sums.ravel())], ["i", "j", "v"])

    sums = np.zeros((k + 1, k))
    for r in vectors.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = r["v"] / basis.n
    return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 16) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_exact for each row and component.

    deviation is the exact sum of (n * x - S)**2, null where it doesn't fit a long; deviation_exact is the same as a
    decimal of 38 digits (null beyond those). The fit list holds each distinct vector once, so copies weigh nothing.
    Its sums are of exact integers, gathered as one row for each pair of dimensions; only the matrix reaches the
    driver. Primes of the polynomial and roots of the components are dealt over tasks.
    Defined cases: vectors that are null, or hold an entry that is null, not finite, or 2**52 and more once scaled,
    are left out; shorter vectors count as if filled with zeros; rows without an id stay, with a null vec_id, and
    rows that share an id give rows each; there are as many components as eigenvalues above 0, at most `count`; so a
    table with fewer than two distinct vectors gives no rows; equal eigenvalues share a space, of which any
    orthonormal basis is taken; further columns are not read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), quantised(F.col(f"`{vector_col}`")).alias("x")).where("x is not null")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    spark = vectors.sparkSession
    if not width:
        return spark.createDataFrame([], schema)
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x"))))
    path = scratch_path(spark, "fit-list")
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    basis = fitted(fit, width, count)
    if not basis.eigenvalues:
        return spark.createDataFrame([], schema)
    error, k = identity_error(fit, basis), len(basis.eigenvalues)
    shared = spark.sparkContext.broadcast(basis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_ = shared.value
        for b in batches:
            y = centred(matrix(b.column("x"), width), b_)
            fits = y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * width < 2**63
            squares = (y * y if fits else y.astype(object) ** 2).sum(axis=1).tolist()
            w, at = projected(y, b_), np.repeat(np.arange(len(b)), k)
            deviation = pa.array([v if v < 2**63 else None for v in squares], pa.int64())
            exact = pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))), pa.array(np.full(n, b_.n)), deviation.take(pa.array(at)),
                 pa.array(w.ravel()), pa.array(np.tile(b_.shares, len(b))), pa.array(np.full(n, error)), exact.take(pa.array(at))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    return rows.mapInArrow(run, schema)
