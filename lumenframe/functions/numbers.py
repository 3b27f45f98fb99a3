"""Numeric expressions."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(col: Column | str, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def poly(x: Column, coefficients: list[float]) -> Column:
    """Horner evaluation, highest power first."""
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


# Published rational approximation of the inverse normal (P. J. Acklam), error below 1.2e-9.
_CENTRE_TOP = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
               1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_CENTRE_LOW = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
               6.680131188771972e+01, -1.328068155288572e+01, 1.0]
_TAIL_TOP = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_TAIL_LOW = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00, 1.0]


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function."""
    q = p - 0.5
    r = q * q
    centre = poly(r, _CENTRE_TOP) * q / poly(r, _CENTRE_LOW)
    low = F.sqrt(-2 * F.ln(p))
    high = F.sqrt(-2 * F.ln(1 - p))
    return (F.when(p < 0.02425, poly(low, _TAIL_TOP) / poly(low, _TAIL_LOW))
            .when(p > 1 - 0.02425, -poly(high, _TAIL_TOP) / poly(high, _TAIL_LOW))
            .otherwise(centre))


# Chebyshev fit of the complementary error function (Numerical Recipes, erfcc), error below 1.2e-7.
_ERFC = [0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196,
         1.00002368, -1.26551223]


def log_normal_cdf(z: Column) -> Column:
    """ln of the standard normal distribution function, stable in the lower tail."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1 / (1 + x / 2)
    log_tail = F.ln(t) - x * x + poly(t, _ERFC) - math.log(2.0)
    return F.when(z < 0, log_tail).otherwise(F.log1p(-F.exp(log_tail)))
