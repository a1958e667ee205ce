"""Tail probabilities for aggregate rows (one row per test), as Arrow UDFs.

Spark has no incomplete beta or error function. These run on results, never on
data rows: Student t and F tails are regularised incomplete beta values
(continued fraction of Lentz; Abramowitz & Stegun 26.5), the normal tail is the
complementary error function.
"""

from __future__ import annotations

import math
import sys
from fractions import Fraction
from itertools import combinations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Smaller sample size up to which the exact rank-sum distribution applies.
EXACT_SAMPLE = 8
#: Terms of the continued fraction; large shapes need many.
MAX_TERMS = 5_000_000

# Ship this module with the tasks: executors need not have the package. Only plain
# functions travel so; one wrapped by functools.cache would be looked up there by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _log_beta(a: float, b: float) -> float:
    small, large = min(a, b), max(a, b)
    if large > 1e6 and small < 1e3:
        # Difference of two huge log-gammas, without the cancellation.
        return math.lgamma(small) - small * math.log(large + (small - 1) / 2)
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function."""
    tiny = 1e-300

    def floor(v: float) -> float:
        return v if abs(v) > tiny else tiny

    c, d = 1.0, 1.0 / floor(1.0 - (a + b) * x / (a + 1.0))
    result = d
    for m in range(1, MAX_TERMS):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0)),
        ):
            d = 1.0 / floor(1.0 + term * d)
            c = floor(1.0 + term / c)
            result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return result
    raise ArithmeticError(f"incomplete beta of {a}, {b}, {x} has not converged")


def beta_tail_value(a: float, b: float, ratio: float) -> float:
    """Regularised incomplete beta at ``1 / (1 + ratio)``."""
    if not (a > 0 and b > 0 and ratio >= 0):
        return math.nan
    if ratio == 0:
        return 1.0
    if math.isinf(ratio):
        return 0.0
    log_x, log_y = -math.log1p(ratio), math.log(ratio) - math.log1p(ratio)
    front = math.exp(a * log_x + b * log_y - _log_beta(a, b))
    x, y = 1.0 / (1.0 + ratio), ratio / (1.0 + ratio)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, y) / b


def _period_counts(parts: int) -> tuple[int, ...]:
    """Coefficients of (1 - q^P)^(parts + 1) / ((1 - q) (1 - q) (1 - q^2) ... (1 - q^parts)).

    P is the least common multiple of 1 .. ``parts``, so this is a polynomial.
    """
    period, found = math.lcm(*range(1, parts + 1)), [1]
    for step in (1, *range(1, parts + 1)):  # times 1 + q^step + q^(2 step) + ... below q^P
        following = [0] * (len(found) + period - step)
        for k in range(len(following)):
            here = found[k] if k < len(found) else 0
            gone = found[k - period] if 0 <= k - period < len(found) else 0
            following[k] = (following[k - step] if k >= step else 0) + here - gone
        found = following
    return tuple(found)


def _partitions_up_to(total: int, parts: int, found: tuple[int, ...]) -> int:
    """Partitions of 0 .. ``total`` into at most ``parts`` parts, whatever the size of ``total``.

    ``found`` are the ``_period_counts`` of ``parts``.
    """
    if total < 0:
        return 0
    period = math.lcm(*range(1, parts + 1))
    first, last = total % period, min(total, len(found) - 1)
    return sum(found[j] * math.comb((total - j) // period + parts, parts) for j in range(first, last + 1, period))


def rank_sum_tail_value(u: float, n1: int, n2: int) -> float:
    """Two-sided p of the exact distribution of U for samples without ties.

    Arrangements with U up to a bound are partitions into at most ``small``
    parts of at most ``large``; those with larger parts are taken out by
    inclusion and exclusion. The smaller sample has at most EXACT_SAMPLE values,
    the other may be of any size.
    """
    small, large = sorted((n1, n2))
    if not 0 < small <= EXACT_SAMPLE:
        raise ValueError(f"exact for a sample of 1 to {EXACT_SAMPLE}, not {small}")
    bound = n1 * n2 - math.ceil(max(u, n1 * n2 - u))
    count, found = 0, _period_counts(small)
    for size in range(small + 1):
        for chosen in combinations(range(1, small + 1), size):
            count += (-1) ** size * _partitions_up_to(bound - sum(large + i for i in chosen), small, found)
    return float(min(Fraction(1), Fraction(2 * count, math.comb(small + large, small))))


@F.pandas_udf(T.DoubleType())
def beta_tail(a: pd.Series, b: pd.Series, ratio: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna([x, y, r]).any() else beta_tail_value(x, y, r) for x, y, r in zip(a, b, ratio)],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """Upper tail doubled: ``2 * P(Z > z)``."""
    return z.map(lambda v: math.erfc(v / math.sqrt(2.0)), na_action="ignore").astype("float64")


@F.pandas_udf(T.DoubleType())
def rank_sum_tail(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """Exact p where one sample is small enough, else missing."""
    return pd.Series(
        [
            None if pd.isna([x, p, q]).any() or not 0 < min(p, q) <= EXACT_SAMPLE else rank_sum_tail_value(x, int(p), int(q))
            for x, p, q in zip(u, n1, n2)
        ],
        dtype="float64",
    )
