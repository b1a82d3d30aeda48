"""Tail of the F distribution, for p-values of a handful of features."""

from __future__ import annotations

import math

MAX_TERMS = 20_000
LARGE = 1e8
PRECISION = 1e-15
TINY = 1e-300


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f) with d1 and d2 degrees of freedom."""
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    if d2 > LARGE:
        # F times d1 tends to the chi-square distribution; its error is of order 1 / d2
        return 1.0 - regularised_gamma(d1 / 2, d1 * f / 2)
    return regularised_beta(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def regularised_beta(x: float, a: float, b: float) -> float:
    """I_x(a, b) by its continued fraction, on the side where the fraction converges quickly."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - regularised_beta(1 - x, b, a)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / (a * _fraction(x, a, b))


def _fraction(x: float, a: float, b: float) -> float:
    """1 + d1/(1 + d2/(1 + …)), evaluated from the front by the modified Lentz scheme."""
    value, c, d = 1.0, 1.0, 0.0
    for n in range(1, MAX_TERMS):
        m = n // 2
        if n % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / ((1.0 + term * d) or TINY)
        c = (1.0 + term / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < PRECISION:
            return value
    raise ArithmeticError(f"No convergence of I_{x}({a}, {b})")


def regularised_gamma(a: float, x: float) -> float:
    """P(a, x) by its power series, or beyond its mean by the continued fraction of the other tail."""
    if x <= 0:
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        for n in range(1, MAX_TERMS):
            term *= x / (a + n)
            total += term
            if term < total * PRECISION:
                return front * total
        raise ArithmeticError(f"No convergence of P({a}, {x})")
    c, d = 1.0 / TINY, 1.0 / (x + 1.0 - a)
    value = d
    for n in range(1, MAX_TERMS):
        term = n * (a - n)
        b = x + 2 * n + 1.0 - a
        d = 1.0 / ((b + term * d) or TINY)
        c = (b + term / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < PRECISION:
            return 1.0 - front * value
    raise ArithmeticError(f"No convergence of P({a}, {x})")
