"""Tail probabilities of test statistics: one number in, one number out, on the driver."""
from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * front
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def student_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def chi_square_upper(x: float, df: float) -> float:
    return gamma_upper(df / 2, x / 2)


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def kolmogorov_upper(d: float, n: float) -> float:
    """Asymptotic tail of the largest gap between distribution functions; n is the effective sample size."""
    x = d * math.sqrt(n)
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


def anderson_normal(a2: float, n: int) -> float:
    """p-value for normality with estimated mean and deviation (D'Agostino and Stephens, 1986)."""
    a = a2 * (1 + 0.75 / n + 2.25 / n ** 2)
    if a < 0.2:
        return 1 - math.exp(-13.436 + 101.14 * a - 223.73 * a * a)
    if a < 0.34:
        return 1 - math.exp(-8.318 + 42.796 * a - 59.938 * a * a)
    if a < 0.6:
        return math.exp(0.9177 - 4.279 * a - 1.38 * a * a)
    return math.exp(1.2937 - 5.709 * a + 0.0186 * a * a) if a < 10 else 3.7e-24


def shapiro_francia_p(w: float, n: int) -> float:
    """p-value of W' (Royston, 1993), made for 5 to 5000 rows; beyond that it is an extrapolation."""
    u = math.log(n)
    v = math.log(u)
    mean = -1.2725 + 1.0521 * (v - u)
    sd = 1.0308 - 0.26758 * (v + 2 / u)
    return 0.5 * math.erfc((math.log(1 - w) - mean) / sd / math.sqrt(2)) if w < 1 else 1.0
