"""Order-insensitive result comparison (Spark rows vs DuckDB rows), columns matched by name."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter


def normalize(v, approx: bool = False):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if approx else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(normalize(x, approx) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, normalize(x, approx)) for k, x in v.items()))
    return v


def multiset(cols: list[str], rows, approx: bool = False) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(normalize(r[i], approx) for i in order) for r in rows)


def same_result(scols, srows, dcols, drows, approx: bool = False) -> bool:
    return sorted(scols) == sorted(dcols) and multiset(scols, srows, approx) == multiset(dcols, drows, approx)
