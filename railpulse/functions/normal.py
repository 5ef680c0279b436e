"""The tail of the normal distribution, as a column."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Up to here the series of the error function, beyond it the continued fraction of its complement.
SERIES_UP_TO = 2.5
TERMS = 90


def error_function_complement(x: Column) -> Column:
    """erfc of a number of at least 0, to about 13 places.

    Both forms are evaluated from their last term inwards, so each needs one running value:
    the series as 1 + 2x²/3 (1 + 2x²/5 (1 + ...)), the fraction as x + (1/2)/(x + (2/2)/(x + ...)).
    """
    inwards = F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1))
    series = F.aggregate(inwards, F.lit(1.0), lambda inner, k: F.lit(1.0) + inner * (x * x * 2.0) / (k * 2 + 1))
    fraction = F.aggregate(inwards, x, lambda inner, k: x + (k / 2.0) / inner)
    bell = F.exp(-x * x) / math.sqrt(math.pi)
    return F.when(x <= SERIES_UP_TO, F.lit(1.0) - bell * x * 2.0 * series).otherwise(bell / fraction)


def two_sided_p(z: Column) -> Column:
    """How likely a standard normal number is at least as far from 0 as ``z``."""
    return error_function_complement(F.abs(z) / math.sqrt(2))
