"""Distribution tails.

Test statistics are computed on executors; the tail probability of each
statistic is a function of one or a few numbers. Two forms are offered:

* column expressions (normal tail via a rational ``erfc`` approximation,
  relative error < 1.2e-7) that stay in the plan, with a matching SQL text
  so DuckDB can repeat them;
* Python functions for chi-squared, t, F and studentized-range tails
  (continued fractions / numerical integration) applied to the small
  statistics table, or through ``pvalue_udf`` as an Arrow-batched UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# Coefficients of the Chebyshev-fitted erfc approximation
# (Numerical Recipes, "erfcc"), lowest order first.
ERFC_COEFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def erfc_col(x: str | Column) -> Column:
    """Complementary error function as a column expression."""
    x = col(x).cast("double")
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFS[-1])
    for c in reversed(ERFC_COEFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def erfc_sql(x: str) -> str:
    """The same approximation as DuckDB SQL text."""
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = f"{ERFC_COEFS[-1]}"
    for c in reversed(ERFC_COEFS[:-1]):
        poly = f"({c} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def norm_cdf_col(z: str | Column) -> Column:
    return F.lit(0.5) * erfc_col(-col(z) / F.lit(math.sqrt(2.0)))


def norm_cdf_sql(z: str) -> str:
    return f"(0.5 * {erfc_sql(f'(-({z}) / {math.sqrt(2.0)})')})"


#: Beyond this many deviations the tail's logarithm comes from its asymptotic form.
FAR = 20.0


def norm_logcdf_col(z: Column) -> Column:
    """ln P(Z <= z), finite in both tails; ln P(Z > z) is that of -z."""
    far = -z * z / 2 - F.ln(F.greatest(-z, F.lit(FAR))) - F.lit(0.5 * math.log(2 * math.pi))
    return F.when(z < -FAR, far).otherwise(F.ln(norm_sf_col(F.greatest(-z, F.lit(-FAR)))))


def norm_logcdf_sql(z: str) -> str:
    far = f"-({z}) * ({z}) / 2 - ln(greatest(-({z}), {FAR})) - {0.5 * math.log(2 * math.pi)!r}"
    return f"CASE WHEN ({z}) < -{FAR} THEN {far} ELSE ln({norm_sf_sql(f'greatest(-({z}), -{FAR})')}) END"


def norm_sf_col(z: str | Column) -> Column:
    return F.lit(0.5) * erfc_col(col(z) / F.lit(math.sqrt(2.0)))


def norm_sf_sql(z: str) -> str:
    return f"(0.5 * {erfc_sql(f'(({z}) / {math.sqrt(2.0)})')})"


# ---------------------------------------------------------------- driver-side tails

def _gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x < 0 or a <= 0:
        return float("nan")
    if x == 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1:  # series for P
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(10000):
            ap += 1
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-15:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - gln)
    b = x + 1 - a  # continued fraction for Q
    c = 1.0 / 1e-300
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    return _gammainc_upper(df / 2.0, max(x, 0.0) / 2.0)


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1e-300 if abs(d) < 1e-300 else d
    d = 1 / d
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student's t."""
    x = df / (df + t * t)
    tail = 0.5 * betainc(df / 2.0, 0.5, x)
    return tail if t > 0 else 1 - tail


def t_two_sided(t: float, df: float) -> float:
    return 2 * t_sf(abs(t), df)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def tukey_sf(q: float, k: int, df: float, n_z: int = 241, n_s: int = 241) -> float:
    """P(Q > q) of the studentized range with ``k`` groups and ``df`` degrees
    of freedom, by numerical integration over the normal and the scaled
    chi distributions (accurate to ~1e-6 for q > 0)."""
    if q <= 0:
        return 1.0
    z = np.linspace(-8, 8, n_z)
    phi = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    cdf = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])

    def range_cdf(w):
        shifted = np.array([0.5 * math.erfc(-(v - w) / math.sqrt(2)) for v in z])
        return k * np.trapezoid(phi * np.power(np.clip(cdf - shifted, 0, 1), k - 1), z)

    if df > 2000:
        return float(1 - range_cdf(q))
    # density of s = sqrt(chi2_df / df)
    s = np.linspace(1e-6, 4.0 if df > 10 else 10.0, n_s)
    logf = (math.log(2) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2)
            + (df - 1) * np.log(s) - df * s * s / 2)
    fs = np.exp(logf)
    vals = np.array([range_cdf(q * si) for si in s])
    return float(max(0.0, 1 - np.trapezoid(fs * vals, s)))


def pvalue_udf(kind: str):
    """Arrow-batched UDF computing a tail probability from statistic column(s).
    ``kind``: ``chi2`` (x, df), ``f`` (f, d1, d2), ``t2`` (t, df), ``tukey`` (q, k, df)."""
    fns = {"chi2": chi2_sf, "f": f_sf, "t2": t_two_sided, "tukey": tukey_sf}
    fn = fns[kind]

    @F.pandas_udf("double")
    def udf(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*[float(c) for c in vals]) if all(v is not None and not pd.isna(v) for v in vals)
                          else float("nan") for vals in zip(*cols)])

    return udf
