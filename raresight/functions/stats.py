"""Tail probabilities for drift tests, applied to per-column result rows only.

The regularised upper incomplete gamma function follows the published series /
continued-fraction evaluation (as in Numerical Recipes, gammq); the normal tail uses
``math.erfc``.  These run on a handful of rows (one per monitored column), through an
Arrow-batched pandas UDF.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


STEPS = 1_000_000  # both expansions need about the square root of a steps


def _gamma_q(a: float, x: float) -> float:
    if x is None or a is None or math.isnan(x) or a <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:  # series for P, return 1 - P
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(STEPS):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-15:
                break
        else:
            raise ArithmeticError(f"the incomplete gamma series does not converge at a={a}, x={x}")
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b = x + 1.0 - a  # continued fraction for Q (modified Lentz)
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, STEPS):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    else:
        raise ArithmeticError(f"the incomplete gamma fraction does not converge at a={a}, x={x}")
    return min(1.0, math.exp(-x + a * math.log(x) - gln) * h)


def chi2_sf(x: float, dof: float) -> float:
    """P(X >= x) for a chi-square variable with ``dof`` degrees of freedom."""
    return _gamma_q(dof / 2.0, x / 2.0)


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), float(b)) if pd.notna(a) and pd.notna(b) else None
                      for a, b in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def norm_sf_udf(z: pd.Series) -> pd.Series:
    return pd.Series([norm_sf(float(v)) if pd.notna(v) else None for v in z], dtype="float64")
