"""Statistics as columns: tails, intervals and rates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def rate(n: Column, d: Column, per: float = 1000.0) -> Column:
    """per * n / d; null where the denominator is empty: a gap is not zero."""
    return F.when(d > 0, F.lit(per) * n / d)


def log_factorial(x: Column) -> Column:
    """ln x! for x >= 0, by Stirling's series eight places further on (error under 1e-12)."""
    z = x + 9.0
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    stirling = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    return stirling - sum((F.log(x + float(i)) for i in range(2, 9)), F.log(x + 1.0))


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P[X >= k] for X ~ Bin(n, p): the greatest term of the tail, from logarithms, times the sum of all terms over it.

    The first term alone may be smaller than any double where k is far below n p. Terms fall from the greatest on to either side; those
    forty deviations and a hundred places away don't change a double any more.
    """
    k, n = k.cast("long"), n.cast("long")
    top = F.greatest(k, F.least(n, F.floor((n + 1) * p)))
    reach = F.ceil(40 * F.sqrt(n * p * (1 - p))) + 100
    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))

    def beside(places: Column, ratio) -> Column:
        def step(a, i):
            t = a["t"] * ratio(i)
            return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

        return F.aggregate(places, start, step)["s"]

    above = F.when(top < n, beside(F.sequence(top + 1, F.least(n, top + reach)), lambda i: (n - i + 1) / i * p / (1 - p))).otherwise(0.0)
    below = F.when(top > k, beside(F.sequence(top - 1, F.greatest(k, top - reach), F.lit(-1).cast("long")), lambda i: (i + 1) / (n - i) * (1 - p) / p)).otherwise(0.0)
    greatest = F.exp(log_factorial(n) - log_factorial(top) - log_factorial(n - top) + top * F.log(p) + (n - top) * F.log1p(-p))
    return F.when((k <= 0) | (p >= 1), F.lit(1.0)).when(p <= 0, F.lit(0.0)).when(k >= n, F.pow(p, n)).otherwise(F.least(F.lit(1.0), greatest * (1 + above + below)))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    p = k / n
    mid = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), mid - half)), F.when(n > 0, F.least(F.lit(1.0), mid + half))


def newcombe(k1: Column, n1: Column, k2: Column, n2: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Interval of a difference of shares."""
    l1, u1 = wilson(k1, n1, z)
    l2, u2 = wilson(k2, n2, z)
    p1, p2 = k1 / n1, k2 / n2
    return p1 - p2 - F.sqrt((p1 - l1) ** 2 + (u2 - p2) ** 2), p1 - p2 + F.sqrt((u1 - p1) ** 2 + (p2 - l2) ** 2)


def normal_tail(z: Column) -> Column:
    """P[Z > z] for z >= 0, by the continued-fraction-free expansion of Abramowitz and Stegun 26.2.17 (error under 7.5e-8)."""
    t = 1 / (1 + F.lit(0.2316419) * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / F.sqrt(2 * F.pi()) * poly


def direction(rho: Column, n: Column, band: float = 0.10) -> Column:
    """Sign of a trend with a dead band: null under three points, 0 for a constant series."""
    return F.when(n < 3, None).when(rho.isNull(), 0).when(rho > band, 1).when(rho < -band, -1).otherwise(0)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(200)


@F.pandas_udf(DoubleType())
def t_tails(t: pd.Series, df: pd.Series) -> pd.Series:
    """P[|T| >= |t|] of Student's t. With t = sqrt(df) tan(a) the density is a power of a cosine, which is integrated from a on; beyond
    forty of its widths nothing is left that a double could hold. Null without t or a degree of freedom."""

    def one(t, df):
        if not (t == t and df >= 1):
            return None
        low = math.atan(abs(t) / math.sqrt(df))
        half = (min(math.pi / 2, low + 40 / math.sqrt(df)) - low) / 2
        area = half * float(_WEIGHTS @ np.cos(low + half * (_NODES + 1)) ** (df - 1))
        return min(1.0, 2 * area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi))

    return pd.Series([one(a, b) for a, b in zip(t.astype(float), df.astype(float), strict=True)], dtype=float)


def correlation_p(rho: Column, n: Column) -> Column:
    """Two-sided p of a correlation of n pairs: null under three pairs or without rho, 0 for a perfect one."""
    t = rho * F.sqrt((n - 2) / F.greatest(1 - rho * rho, F.lit(1e-300)))
    return F.when(rho.isNull() | (n < 3), F.lit(None).cast("double")).when(F.abs(rho) >= 1, F.lit(0.0)).otherwise(F.nanvl(t_tails(t, (n - 2).cast("double")), F.lit(None).cast("double")))
