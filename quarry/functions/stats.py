"""Student's t tail from built-in functions (there is no special function for
it): the regularised incomplete beta function by its continued fraction, a
higher-order aggregate over the terms, without a Python worker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 300
TINY = 1e-300
SHIFT = 10


def log_gamma(x: Column) -> Column:
    """ln Gamma for x > 0: Stirling's series at x + SHIFT, stepped back."""
    z = x + SHIFT
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (
        1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    back = x
    for i in range(1, SHIFT):
        back = back * (x + i)
    return series - F.log(back)


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) > TINY, x).otherwise(F.lit(TINY))


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function (modified Lentz),
    TERMS pairs of terms."""
    def step(s: Column, k: Column) -> Column:
        m = k.cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
        d1 = 1 / _away_from_zero(1 + even * s["d"])
        c1 = _away_from_zero(1 + even / s["c"])
        d2 = 1 / _away_from_zero(1 + odd * d1)
        c2 = _away_from_zero(1 + odd / c1)
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

    first = 1 / _away_from_zero(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["h"])


def t_tail(t: Column, df: Column) -> Column:
    """Two-sided p-value: I_{df / (df + t^2)}(df / 2, 1 / 2); null for null
    arguments and where df is not positive."""
    a, b, x = df / 2, F.lit(0.5), df / (df + t * t)
    turn = x >= (a + 1) / (a + b + 2)  # the fraction converges on one side only
    p, q, y = F.when(turn, b).otherwise(a), F.when(turn, a).otherwise(b), F.when(turn, 1 - x).otherwise(x)
    log_beta = log_gamma(a) + log_gamma(b) - log_gamma(a + b)
    front = F.exp(a * F.log(x) + b * F.log(t * t / (df + t * t)) - log_beta)
    part = front * beta_fraction(p, q, y) / p
    return F.when((df > 0) & (t == 0), F.lit(1.0)).when(df > 0, F.when(turn, 1 - part).otherwise(part))


def t_two_sided_p(t: float, df: float) -> float:
    """The same for two numbers on the driver, by ``math.lgamma``; NaN where df
    is not positive or an argument is not finite."""
    if t is None or df is None or not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return float("nan")
    if t == 0:
        return 1.0
    a, b, x, rest = df / 2, 0.5, df / (df + t * t), t * t / (df + t * t)
    turn = x >= (a + 1) / (a + b + 2)
    p, q, y = (b, a, rest) if turn else (a, b, x)
    d = 1 / (1 - (p + q) * y / (p + 1) or TINY)
    c, h = 1.0, d
    for m in range(1, TERMS + 1):
        for k in (m * (q - m) * y / ((p - 1 + 2 * m) * (p + 2 * m)),
                  -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 1 + 2 * m))):
            d, c = 1 / (1 + k * d or TINY), 1 + k / c or TINY
            h *= d * c
    log_beta = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    part = math.exp(a * math.log(x) + b * math.log(rest) - log_beta) * h / p
    return 1 - part if turn else part
