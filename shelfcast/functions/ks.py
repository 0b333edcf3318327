"""Two-sample Kolmogorov-Smirnov p-values (D10) without SciPy.

``ks_pvalue`` returns P(D >= d) under H0, by the method the caller names, at every
size: ``exact`` counts lattice paths (as a probability walk, diagonal by
diagonal, so nothing overflows), ``asymptotic`` sums the Kolmogorov series. The Spark side calls it
through an Arrow-batched pandas UDF over (d, n1, n2) columns: one call per
(SKU, feature) group, after the statistic itself was computed in SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHODS = ("exact", "asymptotic")
MIN_SAMPLES = 5          # fewer values on either side: no test, p = 1
ALPHA = 0.05


def _exact(d: float, n1: int, n2: int) -> float:
    g = math.gcd(n1, n2)
    lcm = n1 // g * n2
    h = int(round(d * lcm))
    if h == 0:
        return 1.0
    bound = h * g                      # inside the band  <=>  |i*n2 - j*n1| < bound
    total = n1 + n2
    i = np.arange(n1 + 1)
    walk = np.zeros(n1 + 1)            # by i, on the diagonal i + j = step
    walk[0] = 1.0
    for step in range(1, total + 1):
        j = step - i
        valid = (j >= 0) & (j <= n2)
        left = total - step + 1
        across = np.where(j > 0, walk * (n2 - j + 1) / left, 0.0)
        down = np.concatenate([[0.0], walk[:-1] * (n1 - i[1:] + 1) / left])
        walk = np.where(valid & (np.abs(i * n2 - j * n1) < bound), down + across, 0.0)
    return float(min(1.0, max(0.0, 1.0 - walk[n1])))


def _asymptotic(d: float, n1: int, n2: int) -> float:
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = d * en
    if lam < 1e-3:
        return 1.0
    s = sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    return float(min(1.0, max(0.0, 2 * s)))


def ks_pvalue(d: float, n1: int, n2: int, method: str = "exact") -> float:
    if n1 < MIN_SAMPLES or n2 < MIN_SAMPLES or d is None:
        return 1.0
    return (_exact if method == "exact" else _asymptotic)(float(d), int(n1), int(n2))


def ks_pvalue_udf(method: str = "exact"):
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")

    @F.pandas_udf(T.DoubleType())
    def p_value(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series([ks_pvalue(a, int(b), int(c), method) for a, b, c in zip(d, n1, n2)], dtype="float64")

    return p_value
