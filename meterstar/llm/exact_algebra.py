"""Eigenvalues and eigenvectors of a symmetric integer matrix from its exact polynomial.

The characteristic polynomial is computed modulo primes, by reduction to Hessenberg form, and
put together by Chinese remaindering. A symmetric matrix has real roots only, so the sign
changes of the polynomial moved by a count the roots above a, with their multiplicity:
bisection isolates them exactly. The vectors come from inverse iteration in long decimals.

All of this is bounded by the matrix, not by the rows it was summed up from.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import comb, gcd, prod

import numpy as np

ROOT_BITS = 160  # of the largest root
CLUSTER_BITS = 112  # roots that agree in so many of them are one multiple root
DIGITS = 130


def is_prime(n: int) -> bool:
    """Exact below 3.2e9: Miller-Rabin with the bases 2, 3, 5 and 7."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bound: int) -> Iterator[int]:
    """The largest primes of 31 bits, until their product is over `bound`."""
    product, n = 1, 2**31 - 1
    while product <= bound:
        if is_prime(n):
            yield n
            product *= n
        n -= 2


def characteristic_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """det(t - matrix) modulo a prime of at most 31 bits: coefficients from t^0 to t^d."""
    h = np.array(matrix % p, np.int64)
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        h[[m, i]] = h[[i, m]]
        h[:, [m, i]] = h[:, [i, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m][None, :] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor[None, :] % p).sum(1)) % p
    # The polynomials of the leading blocks, each from those before it.
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for m in range(1, d + 1):
        weights, run = np.zeros(m, np.int64), 1
        weights[m - 1] = h[m - 1, m - 1]
        for i in range(m - 2, -1, -1):
            run = run * int(h[i + 1, i]) % p
            weights[i] = int(h[i, m - 1]) * run % p
        polynomials[m, 1:] = polynomials[m - 1, :-1]
        lower = (weights[:, None] * polynomials[:m] % p).sum(0)
        polynomials[m] = (polynomials[m] - lower) % p
    return polynomials[d]


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient of det(t - matrix) is larger in size, if no eigenvalue is negative.

    The k-th symmetric sum of d numbers with a given total is largest if all are equal.
    """
    d, trace = len(matrix), sum(int(matrix[i, i]) for i in range(len(matrix)))
    return max(comb(d, k) * trace**k // d**k for k in range(d + 1)) if d else 1


def remaindered(residues: dict[int, np.ndarray]) -> list[int]:
    """The polynomial of an integer matrix without negative eigenvalues, from its residues.

    Its coefficients alternate in sign from the highest, 1, downwards.
    """
    product = prod(residues)
    parts = [(r, product // p * pow(product // p, -1, p)) for p, r in residues.items()]
    degree = len(parts[0][0]) - 1
    out = []
    for k in range(degree + 1):
        sign = -1 if (degree - k) % 2 else 1
        out.append(sign * (sum(sign * int(r[k]) * unit for r, unit in parts) % product))
    return out


def above(polynomial: list[int], a: int) -> int:
    """How many roots are larger than `a`, with multiplicity; all roots have to be real."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_sign(polynomial: list[int], a: int) -> int:
    value = 0
    for c in reversed(polynomial):
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], many: int) -> tuple[list[tuple[int, int]], int]:
    """The up to `many` largest positive roots of a monic polynomial with real roots only.

    They come as [(root, multiplicity)], largest first, times 2^bits, rounded up, and bits.
    A multiplicity goes beyond `many` if the last root does.
    """
    degree = len(polynomial) - 1
    zeros = next(i for i, c in enumerate(polynomial) if c)  # roots at 0
    polynomial, degree = polynomial[zeros:], degree - zeros
    if not degree:
        return [], 0
    top = abs(polynomial[-2]).bit_length() + 1  # the sum of the roots, none of them negative
    bits = max(0, ROOT_BITS - top)
    scaled = [c << (bits * (degree - k)) for k, c in enumerate(polynomial)]
    out, found = [], 0
    # Intervals (low, high] with the counts of roots above either end, the highest last.
    waiting = [(0, 1 << (top + bits), degree, 0)]
    while waiting and found < many:
        low, high, over_low, over_high = waiting.pop()
        count = over_low - over_high
        if not count:
            continue
        if count == 1:
            out.append((_refined(scaled, low, high, over_high), 1))
            found += 1
        elif high - low <= max(high >> CLUSTER_BITS, 1):
            out.append((high, count))
            found += count
        else:
            middle = (low + high) // 2
            over = above(scaled, middle)
            waiting += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return out, bits


def _refined(polynomial: list[int], low: int, high: int, over: int) -> int:
    """The one root in (low, high], rounded up; `over` roots are larger."""
    # Just below the root the sign differs from that above it, which `over` roots give.
    positive = over % 2 == 0
    while high - low > 1:
        middle = (low + high) // 2
        sign = value_sign(polynomial, middle)
        if sign == 0:
            return middle
        low, high = (low, middle) if (sign > 0) == positive else (middle, high)
    return high


def eigenvectors(matrix: np.ndarray, root: Decimal, many: int) -> np.ndarray:
    """`many` orthonormal vectors, as columns of decimals, of a root of multiplicity `many`.

    Inverse iteration: the matrix less the root is all but singular, so that solving with it
    leaves its null space and next to nothing else of any start. To be called in a context
    of many digits.
    """
    d = len(matrix)
    a = np.array([[Decimal(int(x)) for x in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= root
    tiny = max(abs(x) for x in a.ravel()) * Decimal(10) ** -(DIGITS - 10) or Decimal(1)
    order = list(range(d))
    for c in range(d):
        best = max(range(c, d), key=lambda i: abs(a[i, c]))
        a[[c, best]] = a[[best, c]]
        order[c], order[best] = order[best], order[c]
        if abs(a[c, c]) < tiny:
            a[c, c] = tiny
        a[c + 1 :, c] = a[c + 1 :, c] / a[c, c]
        a[c + 1 :, c + 1 :] -= np.outer(a[c + 1 :, c], a[c, c + 1 :])

    rng = np.random.default_rng(d)
    vectors = [np.array([Decimal(float(x)) for x in rng.normal(size=d)], object) for _ in range(many)]
    for _ in range(3):
        solved = []
        for v in vectors:
            x = v[order].copy()
            for i in range(d):
                x[i] -= a[i, :i] @ x[:i] if i else 0
            for i in reversed(range(d)):
                x[i] = (x[i] - (a[i, i + 1 :] @ x[i + 1 :] if i + 1 < d else 0)) / a[i, i]
            for _ in range(2):
                for u in solved:
                    x = x - u * (u @ x)
            solved.append(x / (x @ x).sqrt())
        vectors = solved
    # Either sign would do; the largest entry is made positive.
    return np.stack([v if max(v, key=abs) > 0 else -v for v in vectors], axis=1)


def decomposed(matrix: np.ndarray, polynomial: list[int], many: int) -> list[tuple[Decimal, np.ndarray]]:
    """(eigenvalue, unit vector as decimals) of the up to `many` largest positive eigenvalues."""
    out = []
    with localcontext(prec=DIGITS):
        roots, bits = largest_roots(polynomial, many)
        for root, multiplicity in roots:
            value = Decimal(root) / Decimal(2) ** bits
            vectors = eigenvectors(matrix, value, multiplicity)
            out += [(value, vectors[:, i]) for i in range(multiplicity)]
    return out[:many]


def common_divisor(matrix: np.ndarray) -> int:
    return gcd(*(int(x) for x in matrix.ravel())) or 1
