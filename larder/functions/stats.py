"""Distribution functions for p-values and confidence intervals (no scipy).

Normal tail via `math.erfc`; Student t tail via the regularised incomplete
beta function, evaluated by a continued fraction (modified Lentz).  Used on
one-row estimator results, either on the driver or inside an Arrow-batched
pandas UDF.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Z_975 = NormalDist().inv_cdf(0.975)


def normal_two_sided_p(z: float | None) -> float | None:
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return None
    return math.erfc(abs(z) / math.sqrt(2.0))


def _betacf(a: float, b: float, x: float, max_iter: int = 400, eps: float = 3e-16) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, max_iter + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc_regularized(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def student_t_two_sided_p(t: float | None, df: float | None) -> float | None:
    if t is None or df is None or df <= 0 or math.isnan(t):
        return None
    return betainc_regularized(df / 2.0, 0.5, df / (df + t * t))


@F.pandas_udf(DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else normal_two_sided_p(float(v))).astype("float64")


@F.pandas_udf(DoubleType())
def student_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    out = [None if (pd.isna(a) or pd.isna(b)) else student_t_two_sided_p(float(a), float(b)) for a, b in zip(t, df)]
    return pd.Series(out, dtype="float64")
