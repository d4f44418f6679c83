"""Eigenvalues and eigenvectors of a symmetric integer matrix without negative eigenvalues, in exact numbers.

* ``residues`` is the characteristic polynomial modulo a prime, by reduction to Hessenberg form; enough
  primes give the polynomial itself by Chinese remaindering (``combined``).
* All roots are real, so by Descartes the sign changes of the polynomial shifted by t are exactly the
  number of roots above t. ``largest_roots`` separates roots by that count and narrows each by signs.
* ``null_vectors`` are the eigenvectors: inverse iteration with the matrix less the root, in fixed point.

A matrix is a numpy array of Python integers; a polynomial the list of its coefficients, lowest first.
"""

from __future__ import annotations

import math

import numpy as np

#: Roots are whole multiples of 2 ** -ROOT_BITS; vectors are computed with WORK_BITS bits after the point.
ROOT_BITS, WORK_BITS = 128, 256


def is_prime(n: int) -> bool:
    """By Miller and Rabin; with these bases it is certain below 3,215,031,751."""
    if n < 9 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(trace: int, d: int) -> list[int]:
    """Primes below 2 ** 31 whose product is beyond twice every coefficient: with ``d`` eigenvalues of
    zero or more, the sum of all products of k of them is largest when all are equal."""
    mean = -(-trace // d)
    need, product, found, n = 2 * max(math.comb(d, k) * mean ** k for k in range(d + 1)) + 1, 1, [], 2 ** 31
    while product <= need:
        n -= 1
        if is_prime(n):
            found.append(n)
            product *= n
    return found


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo the prime ``p``."""
    h, d = (matrix % p).astype(np.int64), len(matrix)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        swap = [m + int(below[0]), m]
        h[[m, swap[0]]] = h[swap]
        h[:, [m, swap[0]]] = h[:, swap]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(1)) % p
    # Polynomials of the leading blocks, each from all smaller ones.
    q = np.zeros((d + 1, d + 1), np.int64)
    q[0, 0] = 1
    for k in range(1, d + 1):
        factor, factors = 1, np.zeros(k, np.int64)
        factors[k - 1] = h[k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            factor = factor * int(h[i + 1, i]) % p
            factors[i] = factor * int(h[i, k - 1]) % p
        q[k, 1:] = q[k - 1, :-1]
        q[k] = (q[k] - (factors[:, None] * q[:k] % p).sum(0)) % p
    return q[d]


def combined(parts: list[tuple[int, list[int]]]) -> list[int]:
    """The integer coefficients, of either sign, from ``parts`` (prime, residues)."""
    product = math.prod(p for p, _ in parts)
    sums = [0] * len(parts[0][1])
    for p, values in parts:
        rest = product // p
        unit = rest * pow(rest % p, -1, p)
        sums = [s + unit * int(v) for s, v in zip(sums, values)]
    return [(s + product // 2) % product - product // 2 for s in sums]


def roots_above(poly: list[int], t: int) -> int:
    """How many roots of ``poly``, all of whose roots are real, are above ``t``."""
    shifted, n = list(poly), len(poly)
    for i in range(n - 1):
        for j in range(n - 2, i - 1, -1):
            shifted[j] += t * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value(poly: list[int], t: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * t + c
    return out


def largest_roots(poly: list[int], most: int) -> list[tuple[int, int]]:
    """(root, multiplicity) of the largest roots of ``poly``, all above zero, falling, until ``most``
    are counted; a root is given in units of 2 ** -ROOT_BITS, rounded up. Roots that agree in all these
    bits count as one."""
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    d = len(poly) - 1
    if not d:
        return []
    fine = [c << ROOT_BITS * (d - i) for i, c in enumerate(poly)]
    found, top = [], -poly[d - 1] << ROOT_BITS  # their sum is above each of them, or the only one
    open_ = [(0, top, d, 0)]
    while open_ and sum(m for _, m in found) < most:
        low, high, more, less = open_.pop()  # roots above low, above high
        if more == less:
            continue
        if more - less == 1 and high - low > 1:
            rising = value(fine, high) > 0 or (value(fine, high) == 0 and less % 2 == 0)
            while high - low > 1:
                middle = (low + high) // 2
                at = value(fine, middle)
                if at == 0:
                    low, high = middle - 1, middle
                elif (at > 0) == rising:
                    high = middle
                else:
                    low = middle
        if high - low == 1:
            found.append((high, more - less))
            continue
        middle = (low + high) // 2
        between = roots_above(fine, middle)
        open_ += [(low, middle, more, between), (middle, high, between, less)]
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    return (x << WORK_BITS) // max(1, math.isqrt(int(x @ x)))


def null_vectors(matrix: np.ndarray, many: int) -> list[list[float]]:
    """``many`` orthogonal unit vectors that the nearly singular integer ``matrix`` takes to almost zero."""
    d, u = len(matrix), matrix.copy()
    order, lower = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(u[k + i, k]))
        for rows in (u, lower, order):
            rows[[k, best]] = rows[[best, k]]
        u[k, k] = u[k, k] or 1
        lower[k + 1:, k] = (u[k + 1:, k] << WORK_BITS) // u[k, k]
        u[k + 1:, k:] -= (lower[k + 1:, k, None] * u[k, k:]) >> WORK_BITS

    def solve(y: np.ndarray) -> np.ndarray:
        y, x = y[order], np.zeros(d, object)
        for k in range(d):
            y[k + 1:] -= (lower[k + 1:, k] * y[k]) >> WORK_BITS
        for k in range(d - 1, -1, -1):
            x[k] = (y[k] << WORK_BITS) // u[k, k]
            y[:k] -= (u[:k, k] * x[k]) >> WORK_BITS
        return x

    found: list[np.ndarray] = []
    for turn in range(many):
        # Any start will do that isn't orthogonal to the vector; these don't depend on the data.
        x = np.array([pow(3, 1 + i + turn * d, 1_000_003) - 500_001 for i in range(d)], object) << WORK_BITS
        for _ in range(3):
            x = _unit(solve(x))
            for _ in range(2):
                for other in found:
                    x = x - ((other * ((other @ x) >> WORK_BITS)) >> WORK_BITS)
            x = _unit(x)
        found.append(x)
    out = []
    for x in found:
        sign = -1 if x[max(range(d), key=lambda i: abs(x[i]))] < 0 else 1
        out.append([sign * int(c) / (1 << WORK_BITS) for c in x])
    return out
