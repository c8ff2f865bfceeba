"""Tail probabilities as column functions: continued fractions and series of a fixed number of terms, evaluated from the end.

All of them are expressions of built-in functions, so they run beside the sums they are applied to. Null or undefined
arguments (degrees of freedom that aren't positive, negative statistics of tests that have none) give null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms; enough for 1e-10 with some hundred degrees of freedom.
TERMS = 160


def _c(x: Column | float) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def _from_end(start: float, step, terms: int = TERMS) -> Column:
    """step(value, k) applied for k = terms, ..., 1."""
    return F.aggregate(F.sequence(F.lit(terms), F.lit(1)), F.lit(start), lambda v, k: step(v, k.cast("double")))


def log_gamma(x: Column | float) -> Column:
    """Logarithm of the gamma function for x > 0, by Stirling's series eight places on."""
    x = _c(x)
    z = x + 8
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.ln(x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0)))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """I_x(a, b) by its continued fraction, for x below (a + 1) / (a + b + 2)."""
    m = lambda k: F.floor(k / 2).cast("double")

    def step(v: Column, k: Column) -> Column:
        even = m(k) * (b - m(k)) * x / ((a + 2 * m(k) - 1) * (a + 2 * m(k)))
        odd = -(a + m(k)) * (a + b + m(k)) * x / ((a + 2 * m(k)) * (a + 2 * m(k) + 1))
        return F.when(k % 2 == 0, even).otherwise(odd) / (1 + v)

    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1 - x)) / a
    return front / (1 + _from_end(0.0, step))


def beta_inc(a: Column | float, b: Column | float, x: Column | float) -> Column:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = _c(a), _c(b), _c(x)
    found = F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x <= (a + 1) / (a + b + 2), _beta_fraction(a, b, x)).otherwise(1 - _beta_fraction(b, a, 1 - x))
    return F.when((a > 0) & (b > 0) & x.isNotNull() & ~F.isnan(x), found)


def gamma_upper(a: Column | float, x: Column | float) -> Column:
    """Regularised upper incomplete gamma function Q(a, x)."""
    a, x = _c(a), _c(x)
    front = F.exp(a * F.ln(x) - x - log_gamma(a))
    low = 1 - front / a * _from_end(1.0, lambda v, k: 1 + x / (a + k) * v)
    high = front / (x + 1 - a + _from_end(0.0, lambda v, k: k * (a - k) / (x + 2 * k + 1 - a + v)))
    return F.when((a > 0) & x.isNotNull() & ~F.isnan(x), F.when(x <= 0, 1.0).when(x < a + 1, low).otherwise(high))


def f_tail(f: Column | float, d1: Column | float, d2: Column | float) -> Column:
    """P(F > f) with d1 and d2 degrees of freedom."""
    f, d1, d2 = _c(f), _c(d1), _c(d2)
    return F.when(f <= 0, 1.0).otherwise(beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)))


def t_tail(t: Column | float, d: Column | float) -> Column:
    """P(|T| > |t|) with d degrees of freedom."""
    t, d = _c(t), _c(d)
    return beta_inc(d / 2, F.lit(0.5), d / (d + t * t))


def chi2_tail(x: Column | float, k: Column | float) -> Column:
    """P(X > x) with k degrees of freedom."""
    return gamma_upper(_c(k) / 2, _c(x) / 2)


def normal_cdf(z: Column | float) -> Column:
    z = _c(z)
    half = gamma_upper(F.lit(0.5), z * z / 2) / 2
    return F.when(z < 0, half).otherwise(1 - half)


# MacKinnon's (1994) response surface for a unit-root test with a constant: the statistic's range, where its two
# polynomials meet, and their coefficients from the constant on.
UNIT_ROOT_RANGE = (-18.83, 2.74)
UNIT_ROOT_MEETS = -1.61
UNIT_ROOT_LOW = (2.1659, 1.4412, 0.038269)
UNIT_ROOT_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + c
    return out


def unit_root_p(tau: Column) -> Column:
    """P value of an augmented Dickey-Fuller statistic with a constant."""
    low, high = UNIT_ROOT_RANGE
    z = F.when(tau <= UNIT_ROOT_MEETS, _polynomial(tau, UNIT_ROOT_LOW)).otherwise(_polynomial(tau, UNIT_ROOT_HIGH))
    return F.when(tau < low, 0.0).when(tau > high, 1.0).when(tau.isNotNull(), normal_cdf(z))


# Critical values of the trend-stationarity test with constant and trend, and their probabilities.
TREND_CRITICAL = ((0.119, 0.10), (0.146, 0.05), (0.176, 0.025), (0.216, 0.01))


def trend_stationary_p(statistic: Column) -> Column:
    """P value of a KPSS statistic with constant and trend, between 0.01 and 0.1, linear between the published points."""
    out = F.when(statistic <= TREND_CRITICAL[0][0], TREND_CRITICAL[0][1])
    for (x0, p0), (x1, p1) in zip(TREND_CRITICAL, TREND_CRITICAL[1:], strict=False):
        out = out.when(statistic <= x1, p0 + (p1 - p0) * (statistic - x0) / (x1 - x0))
    return out.when(statistic.isNotNull(), TREND_CRITICAL[-1][1])
