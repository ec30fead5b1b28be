"""Chi-square tail probability from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stirling series of ln gamma, coefficients of 1/z, 1/z^3, 1/z^5, 1/z^7.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)
SHIFT = 10


def ln_gamma(z: Column) -> Column:
    """Natural log of the gamma function for ``z > 0``: Stirling's series after a shift by ten."""
    shifted = z + F.lit(float(SHIFT))
    series = sum((F.lit(c) / F.pow(shifted, F.lit(2 * i + 1)) for i, c in enumerate(STIRLING)), F.lit(0.0))
    stirling = (shifted - 0.5) * F.ln(shifted) - shifted + 0.5 * F.ln(F.lit(2.0) * F.pi()) + series
    return stirling - sum((F.ln(z + F.lit(float(i))) for i in range(SHIFT)), F.lit(0.0))


def chi_square_p(statistic: Column, df: Column) -> Column:
    """P(X >= statistic) for a chi-square variable; 1 without degrees of freedom, 0 at infinity.

    The lower incomplete gamma series is summed over logs, so no term under- or overflows. Far in
    the tail, where the result is below double precision, it is 0 at once and the series stays short.
    """
    a, x = df.cast("double") / 2, statistic.cast("double") / 2
    tail = x > a + 40 * F.sqrt(a) + 800
    terms = (F.greatest(x - a, F.lit(0.0)) + 12 * F.sqrt(F.greatest(x, a)) + 100).cast("int")
    start = F.struct((a * F.ln(x) - x - ln_gamma(a + 1)).alias("log"), F.lit(0.0).alias("total"))

    def add(state: Column, i: Column) -> Column:
        return F.struct(
            (state["log"] + F.ln(x) - F.ln(a + i)).alias("log"),
            (state["total"] + F.exp(state["log"])).alias("total"),
        )

    lower = F.aggregate(F.sequence(F.lit(1), terms), start, add, lambda state: state["total"])
    return F.when((df <= 0) | (x <= 0), 1.0).when(tail, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - lower))
