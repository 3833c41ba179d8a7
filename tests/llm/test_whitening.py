"""Whitening against floating-point eigenvectors, exact fractions and known matrices."""

import math
import random
from decimal import localcontext
from fractions import Fraction

import numpy as np
import pytest
from llm_rows import DATA

from meterstar.llm import exact_algebra as A
from meterstar.llm import registry
from meterstar.llm import whitening as W


def polynomial(matrix):
    residues = {p: A.characteristic_mod(matrix % p, p).astype(object)
                for p in A.primes(A.coefficient_bound(matrix))}
    return A.remaindered(residues)


def leverrier(matrix):
    """det(t - matrix) in fractions, by traces of powers."""
    d, c, power = len(matrix), [Fraction(1)], np.array(matrix, object) * 0 + np.eye(len(matrix), dtype=int).astype(object)
    for k in range(1, d + 1):
        power = matrix @ power if k == 1 else matrix @ (power + c[-1] * np.eye(d, dtype=int).astype(object))
        c.append(Fraction(-sum(power[i, i] for i in range(d)), k))
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("d", [1, 2, 3, 7, 12])
def test_polynomial_against_traces(d):
    rng = np.random.default_rng(d)
    x = rng.integers(-10**6, 10**6, (max(d - 2, 1), d)).astype(object)  # of less than full rank
    assert polynomial(x.T @ x) == leverrier(x.T @ x)
    blocks = np.kron(np.eye(2, dtype=int), np.ones((d, d), int)).astype(object)  # zero pivots
    assert polynomial(blocks) == leverrier(blocks)


def test_roots_with_multiplicity_and_close_ones():
    def product(roots):
        out = [1]
        for r in roots:
            out = [a - r * b for a, b in zip([0, *out], [*out, 0])]
        return out

    big = 10**30
    for roots in [[3], [0, 0, 5], [7, 7, 7, 3, 0], [big, big + 1, big + 1, 2], [1, 2, 4, 8, 16, 32]]:
        poly = product(roots)
        positive = sorted((r for r in roots if r), reverse=True)
        got, bits = A.largest_roots(poly, 16)
        assert [r for r, k in got for _ in range(k)] == [r << bits for r in positive]
        for a in {0, 1, 3, big, *roots}:
            assert A.above(poly, a) == sum(r > a for r in roots)
    assert A.largest_roots([0, 0, 1], 16) == ([], 0)


@pytest.mark.parametrize("kind", ["full", "rank", "equal", "close", "one"])
def test_components(kind):
    rng = np.random.default_rng(4)
    if kind == "one":
        m = np.array([[9]], object)
    elif kind == "equal":
        m = np.diag([5, 5, 5, 2, 2, 0]).astype(object)
    elif kind == "close":
        m = np.diag([10**25 + 1, 10**25, 10**24]).astype(object) + np.ones((3, 3), int).astype(object)
    else:
        x = rng.integers(-99, 99, (5 if kind == "rank" else 60, 20)).astype(object)
        m = x.T @ x
    found = A.decomposed(m, polynomial(m), 16)
    positive = min(16, {"full": 20, "rank": 5, "equal": 5, "close": 3, "one": 1}[kind])
    assert len(found) == positive
    with localcontext(prec=A.DIGITS):
        scale = max(v for v, _ in found)
        for i, (value, vector) in enumerate(found):
            assert max(abs(x) for x in m @ vector - vector * value) / scale < 1e-40
            for j, (_, other) in enumerate(found[: i + 1]):
                assert abs(vector @ other - (i == j)) < 1e-20


def brute(rows, many):
    """By id: (n, deviation, |whitened|, explained), from fractions and a double eigensolver."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in good), default=0)
    good = [(i, x + [1_000_000] * (width - len(x))) for i, x in good]
    distinct = np.array(sorted({tuple(x) for _, x in good}), object)
    n, s = len(distinct), distinct.sum(0)
    moved = n * distinct - s
    v = (moved.T @ moved).astype(float) / n**3
    e, vectors = np.linalg.eigh(v)
    keep = [k for k in range(width - 1, -1, -1) if e[k] > 1e-9 * e.max()][:many]
    out = {}
    for i, x in good:
        z = ((n * np.array(x, object) - s) / n).astype(float)
        out.setdefault(i, []).append(
            (n, int(((n * np.array(x, object) - s) ** 2).sum()),
             [abs(z @ vectors[:, k]) / math.sqrt(e[k]) for k in keep], [e[k] / e.sum() for k in keep]))
    return out


def check(got, rows, many=16):
    expected = brute(rows, many)
    seen = {}
    for r in got:
        seen.setdefault(r.vec_id, []).append(r)
        assert r.identity_error < 1e-9
    assert set(seen) == set(expected)
    for i, copies in expected.items():
        own = sorted(seen[i], key=lambda r: r.component)
        assert len(own) == sum(len(c[2]) for c in copies)
        if len(copies) > 1:
            continue
        n, deviation, whitened, explained = copies[0]
        assert [r.component for r in own] == list(range(1, len(own) + 1))
        assert all(r.n == n and r.deviation == deviation for r in own)
        np.testing.assert_allclose([abs(r.whitened) for r in own], whitened, rtol=1e-6, atol=1e-6)
        np.testing.assert_allclose([r.explained for r in own], explained, rtol=1e-9)


def make(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n") for i, v in rows],
                                 "vec_id bigint, embedding array<double>, whitened int, id string")


def test_against_brute_force_with_all_kinds_of_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1 + k) + rng.random() for k in range(6)]) for i in range(150)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (501, rows[4][1]), (None, rows[5][1] + [0.0]), (502, [0.25] * 3),
             (503, None), (504, [1.0, None]), (505, [float("nan")] * 6), (506, [float("-inf")] * 6), (507, [])]
    check(W.whitened_components(make(spark, rows)).collect(), rows)


def test_huge_entries_are_summed_exactly(spark):
    y = np.array([[2**60, -(2**60) + 5, 3], [-(2**59), 2**40 + 1, -7]], np.int64)
    assert (W.products(y) == y.astype(object).T @ y.astype(object)).all()
    rows = [(i, [1e300 * (i % 2), 1e17 * i, 1e16 * (i * i % 7)]) for i in range(9)]
    got = W.whitened_components(make(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3} and all(r.identity_error < 1e-4 for r in got)
    assert all(r.deviation is None for r in got)


def test_tables_without_variance_have_no_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        df = W.whitened_components(make(spark, rows))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.collect() == []


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check(registry.op12_whitening(spark, DATA).collect(), rows)
