"""Tail probabilities of the F and normal distributions.

Spark SQL has neither. They are Arrow UDFs meant for summary rows (one per test),
never for the data itself: t, Pearson and Granger tests all end in an F tail.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Steps of the continued fraction grow with the square root of the larger parameter.
_STEPS_PER_ROOT = 20


def _stirling(x: float) -> float:
    """What log-gamma adds to (x - 1/2) log x - x + log(2 pi) / 2, for x of 10 or more."""
    y = 1.0 / (x * x)
    return (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / x


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(gamma(a + b) / gamma(a)) without the difference of two large numbers."""
    shift = max(0, math.ceil(10.0 - a))
    low = sum(math.log((a + k) / (a + b + k)) for k in range(shift))
    a += shift
    main = (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b
    return low + main + _stirling(a + b) - _stirling(a)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value = d
    for m in range(1, 1000 + int(_STEPS_PER_ROOT * math.sqrt(max(a, b)))):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + numerator / c
            c = c if abs(c) > floor else floor
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"the beta fraction did not converge for {a}, {b}, {x}")


def regularized_beta(a: float, b: float, x: float, rest: float | None = None) -> float:
    """I_x(a, b). ``rest`` is 1 - x, for callers that know it with more digits."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0:
        return 0.0
    if rest <= 0.0:
        return 1.0
    small, large = sorted((a, b))
    log_front = _log_gamma_ratio(large, small) - math.lgamma(small)
    # The logarithm of the side that is nearer to 1 comes from the other one.
    log_front += a * (math.log(x) if x < 0.5 else math.log1p(-rest))
    log_front += b * (math.log(rest) if rest < 0.5 else math.log1p(-x))
    if x * (a + b + 2.0) < a + 1.0:
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, rest) / b


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(X > f) for an F(d1, d2) variable; NaN when it is undefined."""
    if any(v is None or math.isnan(v) for v in (f, d1, d2)) or d1 <= 0 or d2 <= 0:
        return math.nan
    if f <= 0.0:
        return 1.0
    if math.isinf(f):
        return 0.0
    whole = d2 + d1 * f
    return regularized_beta(d2 / 2.0, d1 / 2.0, d2 / whole, d1 * f / whole)


@F.pandas_udf(DoubleType())
def _f_sf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    # A NaN result reaches Spark as null.
    return pd.Series([f_tail(*row) for row in zip(f, d1, d2)], dtype="float64")


@F.pandas_udf(DoubleType())
def _normal_two_sided(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: math.erfc(v / math.sqrt(2.0)), na_action="ignore")


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of F(d1, d2); null when undefined."""
    return F.nullif(_f_sf(f.cast("double"), d1.cast("double"), d2.cast("double")), F.lit(math.nan))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|) for a standard normal Z."""
    return F.nullif(_normal_two_sided(z.cast("double")), F.lit(math.nan))


# Workers need no installed copy of this package to run the UDFs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
