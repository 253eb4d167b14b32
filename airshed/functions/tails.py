"""Tail probabilities as column expressions: chi-square, Student, F.

Incomplete gamma and beta functions from their series and continued fractions.  Sums run
inside ``aggregate``, so an expression stays small and evaluates in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

STEPS = 400
TINY = 1e-300
# Coefficients of the Lanczos approximation for g = 7.
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0; relative error about 1e-14."""
    z = x - 1
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + i)
    t = z + 7.5
    return 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.log(t) - t + F.log(series)


def _repeat(start: dict[str, Column], step, result, first: int = 1, steps: int = STEPS) -> Column:
    """``result`` of the state after ``step(state, k)`` for k from ``first`` on."""
    state = F.struct(*[v.cast("double").alias(k) for k, v in start.items()])

    def turn(s: Column, k: Column) -> Column:
        return F.struct(*[v.cast("double").alias(n) for n, v in step(s, k).items()])

    return F.aggregate(F.sequence(F.lit(first), F.lit(first + steps - 1)), state, turn, result)


def _away(x: Column) -> Column:
    """Lentz's method must not divide by zero."""
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def gamma_tail(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma function Q(a, x) for a > 0, x >= 0."""
    a, x = a.cast("double"), x.cast("double")
    front = F.exp(-x + a * F.log(x) - log_gamma(a))
    series = _repeat({"term": 1 / a, "sum": 1 / a},
                     lambda s, k: {"term": s["term"] * x / (a + k), "sum": s["sum"] + s["term"] * x / (a + k)},
                     lambda s: s["sum"])
    b = x + 1 - a

    def step(s: Column, k: Column) -> dict[str, Column]:
        part, width = -k * (k - a), b + 2 * k
        d = 1 / _away(part * s["d"] + width)
        c = _away(width + part / s["c"])
        return {"c": c, "d": d, "h": s["h"] * c * d}

    fraction = _repeat({"c": F.lit(1 / TINY), "d": 1 / _away(b), "h": 1 / _away(b)}, step, lambda s: s["h"])
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - front * series).otherwise(front * fraction)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    start = 1 / _away(1 - (a + b) * x / (a + 1))

    def half(s: dict[str, Column], part: Column) -> dict[str, Column]:
        d = 1 / _away(1 + part * s["d"])
        c = _away(1 + part / s["c"])
        return {"c": c, "d": d, "h": s["h"] * c * d}

    def even(s: Column, m: Column) -> dict[str, Column]:
        return half({k: s[k] for k in ("c", "d", "h")}, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))

    def odd(s: Column, m: Column) -> dict[str, Column]:
        return half({k: s[k] for k in ("c", "d", "h")}, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))

    # Even and odd steps alternate; k counts both.
    def step(s: Column, k: Column) -> dict[str, Column]:
        m = F.floor(k / 2)
        first, second = even(s, m), odd(s, m)
        return {n: F.when(k % 2 == 0, first[n]).otherwise(second[n]) for n in ("c", "d", "h")}

    return _repeat({"c": F.lit(1.0), "d": start, "h": start}, step, lambda s: s["h"], first=2)


def beta_share(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta function I_x(a, b) for a, b > 0 and x in [0, 1]."""
    x, a, b = (c.cast("double") for c in (x, a, b))
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    low = front * _beta_fraction(x, a, b) / a
    high = 1 - front * _beta_fraction(1 - x, b, a) / b
    return (F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0))
            .when(x < (a + 1) / (a + b + 2), low).otherwise(high))


def chi_square_tail(x: Column, freedom: Column) -> Column:
    """Probability of a chi-square value above x."""
    return F.when(freedom > 0, gamma_tail(freedom / 2, x / 2))


def student_two_sided(t: Column, freedom: Column) -> Column:
    """Probability of a Student t further from zero than t."""
    return F.when(freedom > 0, beta_share(freedom / (freedom + t * t), freedom / 2, F.lit(0.5)))


def f_tail(f: Column, above: Column, below: Column) -> Column:
    """Probability of an F value above f."""
    return F.when((above > 0) & (below > 0), beta_share(below / (below + above * f), below / 2, above / 2))
