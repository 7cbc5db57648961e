"""Binomial tails whose first term is smaller than any double."""

import math

import pytest
from pyspark.sql import functions as F

from unisono.functions.stats import binomial_tail, log_factorial


def _tail(k, n, p):
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k, n + 1))


def test_tails_far_below_and_above_the_mean(spark):
    cases = [(1500, 6000, 0.5), (2900, 6000, 0.5), (3100, 6000, 0.5), (1, 20000, 0.4), (5, 9, 0.02), (1, 1, 0.3), (19999, 20000, 0.9), (20000, 20000, 0.9), (700, 20000, 0.03)]
    rows = spark.createDataFrame(cases, "k long, n long, p double").select("k", "n", "p", binomial_tail(F.col("k"), F.col("n"), F.col("p")).alias("t")).collect()
    for r in rows:
        assert r.t == pytest.approx(min(1.0, _tail(r.k, r.n, r.p)), rel=1e-8), r


def test_log_factorial(spark):
    rows = spark.createDataFrame([(x,) for x in (0, 1, 2, 9, 170, 10**6)], "x long").select("x", log_factorial(F.col("x")).alias("f")).collect()
    for r in rows:
        assert r.f == pytest.approx(math.lgamma(r.x + 1), rel=1e-12, abs=1e-11)
