"""Statistical Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_div(num: Column, den: Column, min_abs: float = 1e-6) -> Column:
    """num / den, NULL where abs(den) < min_abs (no division-by-zero error)."""
    return F.try_divide(num, F.when(F.abs(den) >= F.lit(min_abs), den))


def skew_unbiased(x: Column) -> Column:
    """Bias-corrected sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2).

    Spark's ``skewness`` is the biased g1; NULL when n < 3.
    """
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_unbiased(x: Column) -> Column:
    """Bias-corrected excess kurtosis G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)."""
    n = F.count(x).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def log10_positive(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))
