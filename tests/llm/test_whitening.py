import math
import random
from fractions import Fraction

import numpy as np
import pytest

from bulwark.llm import whitening

ROWS = "vec_id long, embedding array<float>"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]


def poly_of(roots):
    f = [1]
    for r in roots:
        f = [a - r * b for a, b in zip([0, *f], [*f, 0], strict=True)]
    return f


def brute(rows, count=16):
    """n, deviation and whitened coordinates (up to signs) by numpy's eigensolver."""
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in ok), default=0)
    x = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))) for i, v in ok]
    fit = sorted({v for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    z = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, s, strict=True)] for v in fit]).reshape(n, width)
    e, c = np.linalg.eigh(z.T @ z / max(n, 1))
    order = np.argsort(-e)[:count]
    e, c, all_ = e[order], c[:, order], e.sum()
    deviation = {v: sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) for v in fit}
    at = {v: i for i, v in enumerate(fit)}
    keep = e > 1e-9 * max(all_, 1e-300)
    w = z @ c[:, keep] / np.sqrt(e[keep])
    return [(i, n, deviation[v], w[at[v]], e[keep] / all_) for i, v in x]


def found(spark, rows, **how):
    got = whitening.whitened(spark.createDataFrame(rows, ROWS), **how)
    assert got.columns == COLUMNS
    out = {}
    for r in got.collect():
        out.setdefault((r["vec_id"], r["n"], r["deviation"]), []).append(r)
        assert int(r["deviation_exact"]) == r["deviation"] and 0 <= r["identity_error"] <= 1e-8
    return {k: sorted(v, key=lambda r: r["component"]) for k, v in out.items()}


def test_matches_eigensolver(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 20)) @ np.diag(np.linspace(2, 0.2, 20)) @ rng.normal(size=(20, 20)) + 3
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies weigh nothing
    got, signs = found(spark, rows), None
    for i, n, deviation, w, share in brute(rows):
        mine = got[i, n, deviation]
        assert [r["component"] for r in mine] == list(range(1, 17))
        x = np.array([r["whitened"] for r in mine])
        signs = np.sign(x * w) if signs is None else signs
        assert np.allclose(x, w * signs, atol=1e-7) and np.allclose([r["explained"] for r in mine], share, rtol=1e-8)


def test_odd_vectors(spark):
    rows = [(1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (5, [3e38, 0.0]), (6, [1.0]), (6, [1.0, 2.0]),
            (None, [0.5, -2.0]), (7, []), (8, [4.0, 4.0]), (8, [4.0, 4.0])]
    got = whitening.whitened(spark.createDataFrame(rows, ROWS))
    held = [r for r in rows if r[0] not in (1, 2, 3, 4, 5)]
    plain = brute(held)
    assert got.count() == 2 * len(held)
    assert sorted((str(r["vec_id"]), r["n"], r["deviation"]) for r in got.where("component = 1").collect()) == sorted((str(i), n, d) for i, n, d, _, _ in plain)
    for few in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]):
        assert whitening.whitened(spark.createDataFrame(few, ROWS)).count() == 0


def test_equal_eigenvalues_and_missing_rank(spark):
    """The corners of a cube in 3 of 5 dimensions: one eigenvalue three times, twice 0."""
    rows = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1), 7.0, 7.0]) for i in range(8)]
    got = whitening.whitened(spark.createDataFrame(rows, ROWS)).collect()
    assert len(got) == 24 and {round(r["explained"], 12) for r in got} == {round(1 / 3, 12)} and max(r["identity_error"] for r in got) < 1e-9
    for i in range(8):
        assert math.isclose(sum(r["whitened"] ** 2 for r in got if r["vec_id"] == i), 3, rel_tol=1e-9)


def test_large_entries(spark):
    """Sums beyond 64 bits stay exact; a deviation that fits no long is null there."""
    rows = [(i, [float(10**9 * (i % 7)), float(i), float(-(10**9) * (i % 3))]) for i in range(300)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()
    x = {r[0]: [math.floor(64 * c) + 1_000_000 for c in r[1]] for r in rows}
    n, s = len(set(map(tuple, x.values()))), [sum(c) for c in zip(*set(map(tuple, x.values())), strict=True)]
    for r in got:
        exact = sum((n * a - b) ** 2 for a, b in zip(x[r["vec_id"]], s, strict=True))
        assert int(r["deviation_exact"]) == exact and r["deviation"] == (exact if exact < 2**63 else None) and r["identity_error"] < 1e-8


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_is_exact(spark, seed):
    rng = random.Random(seed)
    d = [1, 2, 5, 9][seed]
    a = np.array([[rng.randrange(-50, 50) * (rng.random() < 0.6) for _ in range(d + seed)] for _ in range(d)], object)
    m = a @ a.T
    f = whitening.characteristic(spark, m)
    assert f[-1] == 1 and -f[-2] == sum(m.diagonal())
    # Cayley-Hamilton, in whole numbers
    value = np.zeros((d, d), object)
    for c in reversed(f):
        value = value @ m + np.eye(d, dtype=int).astype(object) * c
    assert not value.any()


def test_roots_and_multiplicities():
    roots = [5, 5, 5, 9, 9, 1, 10**12, 10**12 + 1]
    parts = dict(whitening.by_multiplicity(poly_of(roots)))
    assert parts == {1: poly_of([1, 10**12, 10**12 + 1]), 2: poly_of([9]), 3: poly_of([5])}
    assert [whitening.roots_beyond(poly_of(roots), 9 * 2 + k, 1) for k in (-1, 0, 1)] == [4, 2, 2]
    found = [whitening.narrowed(parts[1], *r, Fraction(1, 2**80)) for r in whitening.largest_roots(parts[1], 3, 3 * 10**12)]
    assert [round(Fraction(a, 1 << s)) for a, s in found] == [10**12 + 1, 10**12, 1]
    irrational = [-2, 0, 1]  # x**2 - 2
    a, s = whitening.narrowed(irrational, *whitening.largest_roots(irrational, 1, 4)[0], Fraction(1, 2**200))
    assert abs(Fraction(a, 1 << s) ** 2 - 2) < Fraction(1, 2**190)
    assert [p for p in range(200) if whitening.is_prime(p)] == [p for p in range(2, 200) if all(p % q for q in range(2, p))]


def test_close_roots_have_their_own_components(spark):
    """Eigenvalues that differ by one part in 10**13: doubles could not tell these directions apart."""
    big = 10**13
    m = np.array([[big, 0, 0], [0, big + 1, 0], [0, 0, 5]], object)
    found = whitening.components(spark, m, 3)
    assert [int(r) for r, _ in found] == [big + 1, big, 5] or [round(r) for r, _ in found] == [big + 1, big, 5]
    assert [int(np.abs(v).argmax()) for _, v in found] == [1, 0, 2] and all(abs(np.abs(v).max() - 1) < 1e-12 for _, v in found)


def test_gram_is_exact():
    rng = random.Random(1)
    for size in (10, 2**20, 2**45, 2**58):
        z = np.array([[rng.randrange(-size, size) for _ in range(3)] for _ in range(50)], np.int64)
        plain = [[sum(int(a[i]) * int(a[j]) for a in z) for j in range(3)] for i in range(3)]
        assert whitening.exact_gram(z).tolist() == plain


def test_registered_query(spark, sf):
    from bulwark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in QUERIES["op11_characteristic_whitening"](spark, sf).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = None
    for i, n, deviation, w, share in brute(rows):
        mine = [got[i][c] for c in range(1, 17)]
        x = np.array([r["whitened"] for r in mine])
        signs = np.sign(x * w) if signs is None else signs
        assert {(r["n"], r["deviation"]) for r in mine} == {(n, deviation)} and np.allclose(x, w * signs, atol=1e-6)
        assert np.allclose([r["explained"] for r in mine], share, rtol=1e-6) and mine[0]["identity_error"] < 1e-6
