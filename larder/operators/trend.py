"""Piecewise-linear trends with change points, a weekly and a yearly cycle, one model per series (M6).

The trend is a line that may bend at change points spread over the first 80 % of
the training dates; an L1 penalty keeps most bends at zero.  All regressors depend on
the date alone, so the training rows of a series enter as one cell per date (partial aggregates), and a
series' task holds at most one cell per day of the lookback, however many rows it has.  From its cells'
Gram matrix the unpenalised and ridge terms are eliminated exactly; coordinate
descent with soft thresholds then runs over the bends alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from larder.operators import forecast as fc
from larder.operators.marts import HOT_SERIES_ROWS, SERIES

SCHEMA = ("item_id string, store_id string, n_train long, n_holdout long, mae double, mape double, slope double, "
          "changes array<struct<ds: date, delta: double>>, yhat_7 double, yhat_14 double, train_end date")
#: Fixed values, the usual defaults of such forecasters: change points, the share of the dates that they lie in, cycles.
CHANGE_POINTS, CHANGE_RANGE, WEEKLY, YEARLY = 25, 0.8, 3, 10


def soft_threshold(x: float, by: float) -> float:
    return math.copysign(max(abs(x) - by, 0.0), x)


def penalised_fit(gram: np.ndarray, moment: np.ndarray, ridge: np.ndarray, bends: np.ndarray, penalty: float,
                  tolerance: float = 1e-12, rounds: int = 20_000) -> np.ndarray:
    """Minimise b' gram b / 2 - moment' b + sum(ridge * b^2) / 2 + penalty * sum(|b| over `bends`)."""
    free = np.setdiff1d(np.arange(len(moment)), bends)
    own = gram[np.ix_(free, free)] + np.diag(ridge[free])
    cross = gram[np.ix_(free, bends)]
    inverse = np.linalg.pinv(own)
    q = gram[np.ix_(bends, bends)] - cross.T @ inverse @ cross
    c = moment[bends] - cross.T @ inverse @ moment[free]
    delta, left = np.zeros(len(bends)), c.copy()  # left = c - q delta
    scale = max(float(np.abs(c).max(initial=0.0)), 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(bends)):
            if q[j, j] <= 1e-14:
                continue
            new = soft_threshold(left[j] + q[j, j] * delta[j], penalty) / q[j, j]
            step = new - delta[j]
            if step:
                left -= q[:, j] * step
                delta[j] = new
                moved = max(moved, abs(step) * q[j, j])
        if moved <= tolerance * scale:
            break
    out = np.zeros(len(moment))
    out[bends] = delta
    out[free] = inverse @ (moment[free] - cross @ delta)
    return out


def change_point_days(t: np.ndarray, count: int = CHANGE_POINTS, share: float = CHANGE_RANGE) -> np.ndarray:
    """Days of the change points, at equal steps through the first part of the dates that there are."""
    n = int(len(t) * share)
    count = min(count, max(n - 1, 0))
    return t[np.unique(np.round(np.linspace(0, n - 1, count + 1)).astype(int))[1:]] if count else np.empty(0)


def design(t: np.ndarray, start: float, span: float, at: np.ndarray) -> np.ndarray:
    """Level, slope, bends (all in spans), then the weekly cycle and, from two years of dates on, the yearly one.

    In a shorter span a yearly cycle cannot be told from a bend.
    """
    x = (t - start) / span
    cols = [np.ones_like(x), x, *[np.maximum(x - (s - start) / span, 0.0) for s in at]]
    for period, order in ((7.0, WEEKLY), (365.25, YEARLY if span >= 2 * 365 else 0)):
        for k in range(1, order + 1):
            cols += [np.sin(2 * math.pi * k * t / period), np.cos(2 * math.pi * k * t / period)]
    return np.column_stack(cols)


def fit_series(t: np.ndarray, n: np.ndarray, total: np.ndarray, penalty: float, ridge: float) -> dict:
    """The model of one series from its cells (ascending days, rows, sums)."""
    start, span = float(t[0]), max(float(t[-1] - t[0]), 1.0)
    at = change_point_days(t)
    x, rows = design(t, start, span, at), float(n.sum())
    scale = max(float(np.abs(total / n).max()), 1e-12)
    gram, moment = (x.T * (n / rows)) @ x, x.T @ (total / scale / rows)
    bends = np.arange(2, 2 + len(at))
    weights = np.full(x.shape[1], ridge)
    weights[:2 + len(at)] = 0.0
    beta = penalised_fit(gram, moment, weights, bends, penalty) * scale
    return {"start": start, "span": span, "at": at, "beta": beta,
            "predict": lambda days: design(np.asarray(days, float), start, span, at) @ beta}


def _one(pdf: pd.DataFrame, min_rows: int, penalty: float, ridge: float) -> pd.DataFrame:
    names = ("item_id", "store_id", "n_train", "n_holdout", "mae", "mape", "slope", "changes", "yhat_7", "yhat_14", "train_end")
    t, n, total, tail_t, y = fc.split_cells(pdf)
    if n.sum() + len(y) < min_rows or n.sum() < 2 or np.ptp(t) == 0:
        return pd.DataFrame(columns=list(names))
    model = fit_series(t, n, total, penalty, ridge)
    err = np.abs(y - model["predict"](tail_t))
    day = lambda d: (pd.Timestamp(fc.EPOCH) + pd.Timedelta(days=int(d))).date()
    deltas = model["beta"][2:2 + len(model["at"])] / model["span"]
    changes = [{"ds": day(s), "delta": float(v)} for s, v in zip(model["at"], deltas, strict=True) if v]
    ahead = model["predict"](t[-1] + np.array([7.0, 14.0]))
    return pd.DataFrame([(
        pdf["item_id"].iloc[0], pdf["store_id"].iloc[0], int(n.sum()), len(y), float(err.mean()) if len(err) else None,
        float((err[y != 0] / y[y != 0]).mean()) if (y != 0).any() else None, float(model["beta"][1] / model["span"]), changes,
        round(float(ahead[0]), 4), round(float(ahead[1]), 4), day(t[-1]))], columns=list(names))


def change_point_forecasts(df: DataFrame, holdout: int = 14, min_rows: int = 16, penalty: float = 2e-4, ridge: float = 1e-3,
                           hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """One row per series of at least `min_rows` rows: errors on its last `holdout` rows, the slope at its start and
    its bends (per day), and the forecasts 7 and 14 days after its training rows.

    `penalty` and `ridge` apply to prices in units of the series' largest daily mean, averaged over its rows.
    """
    return fc.date_cells(df, holdout, hot_series_rows).groupBy(*SERIES).applyInPandas(
        lambda pdf: _one(pdf, max(min_rows, holdout + 2), penalty, ridge), SCHEMA)
