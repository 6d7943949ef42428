"""Per-series price forecasts.

Model families, each fitted for every series at once:

* `trend_weekday` (native): y = a + b * t + w[weekday], with a, b by least
  squares over the training rows and w the mean training residual per weekday,
  both from exact sums per (series, weekday).
* `fourier` (Python): ridge regression on trend + weekly (order 3) and
  yearly (order 10) Fourier terms, one `applyInPandas` call per series over
  its dates' sums, which the lookback window bounds.

* `change_points` (Python, `trend.py`): a piecewise-linear trend with L1-penalised
  bends and both cycles.

The last `holdout` rows of each series are held out (series need at least
`min_rows` rows in the lookback, and at least 2 distinct training dates).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators import boosting
from larder.operators import features as fe
from larder.operators.marts import (
    CHUNK_COLUMNS, HOT_SERIES_ROWS, SERIES, TIEBREAK, skew_safe_series_window, with_chunks,
)
from larder.session import store

EPOCH = "1970-01-01"
BOUND_LEVEL = 0.95  # fixed value: the level of the forecasts' bounds


def _as_of(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def forecast_input(history: DataFrame, lookback_days: int = 90, as_of=None) -> DataFrame:
    return history.filter(F.col("price_date") >= F.date_sub(_as_of(as_of), lookback_days)).select(
        *SERIES, "price_date", TIEBREAK, "regular_price")


def holdout_tail(df: DataFrame, holdout: int = 14, tiebreak: str = TIEBREAK,
                 hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """Rank from the end of each series; `is_holdout` marks the last `holdout` rows.

    Hot series: counted in the chunk, plus the rows of the chunks behind it; no
    window holds a whole hot series.
    """
    if hot_series_rows is None:
        df, keys = df.withColumns({"_firsts": F.lit(None).cast("array<long>"), "_rows": F.lit(None).cast("long"),
                                   "_chunk": F.lit(0), "_context": F.lit(False)}), SERIES
    else:
        df, keys = with_chunks(df, hot_series_rows), (*SERIES, "_chunk")
    desc = Window.partitionBy(*keys).orderBy(F.col("price_date").desc(), F.col(tiebreak).desc())
    here = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    upto = F.coalesce(F.get("_firsts", F.col("_chunk") + 1), F.col("_rows"))  # rows of the series up to the chunk's end
    return df.withColumns({
        "rn_desc": (F.row_number().over(desc) + F.coalesce(F.col("_rows") - upto, F.lit(0))).cast("int"),
        "series_rows": F.coalesce(F.col("_rows"), here),
    }).withColumn("is_holdout", F.col("rn_desc") <= holdout).drop(*CHUNK_COLUMNS)


def residual_target(df: DataFrame, tiebreak: str = TIEBREAK,
                    hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """X - previous x, first row of a series -> 0 (back-filled); hot series in chunks."""
    def compute(d: DataFrame, w) -> DataFrame:
        return d.withColumn("_prev", F.lag("regular_price").over(w))

    out = skew_safe_series_window(df, compute, before=1, after=0, hot_rows=hot_series_rows, tiebreak=tiebreak)
    return out.withColumn("residual_target", F.col("regular_price") - F.coalesce("_prev", "regular_price")).drop("_prev")


def _days(d: Column) -> Column:
    return F.datediff(d, F.lit(EPOCH).cast("date")).cast("double")


def flag_holdout(df: DataFrame, holdout: int, hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """`is_holdout`: no row lies `holdout` places ahead in the series (a window of bounded reach, chunked if hot)."""
    def flag(d: DataFrame, w) -> DataFrame:
        return d.withColumn("is_holdout", F.lead(F.lit(1), holdout).over(w).isNull())

    return skew_safe_series_window(df, flag, before=0, after=holdout, hot_rows=hot_series_rows)


def fit_trend_weekday(df: DataFrame, holdout: int = 14, min_rows: int = 14,
                      hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """One row per eligible series: the fitted model and its held-out rows.

    No step needs a whole series in one task, and the rows are read once: slope and
    weekday effects depend on the sums of n, t, t^2, y and ty per weekday alone,
    which are exact (days and decimals) and partially aggregated; a mean
    residual is linear in them, so no row is met again.  The held-out rows, `holdout` a series,
    are kept as a list.
    """
    rows = flag_holdout(df, holdout, hot_series_rows).withColumns({
        "t": F.datediff("price_date", F.lit(EPOCH).cast("date")).cast("decimal(10,0)"),
        "y": F.col("regular_price").cast("decimal(18,4)"), "dow": F.weekday("price_date")})
    train = ~F.col("is_holdout")
    both = train & F.col("t").isNotNull() & F.col("y").isNotNull()
    total = lambda c: F.sum(F.when(both, c)).cast("decimal(38,4)")
    days = rows.groupBy(*SERIES, "dow").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(train, F.col("t"))).alias("n_train"),
        F.count(F.when(both, F.lit(1))).alias("n"), total(F.col("t")).alias("st"),
        total(F.col("t") * F.col("t")).alias("stt"), total(F.col("y")).alias("sy"),
        total(F.col("t") * F.col("y")).alias("sty"),
        F.max(F.when(train, F.col("price_date"))).alias("train_end"), F.max("price_date").alias("series_end"),
        F.collect_list(F.when(~train, F.struct(F.col("t").cast("double").alias("t"), F.col("y").cast("double").alias("y"),
                                               "dow"))).alias("tail"))
    zero = F.lit(0).cast("decimal(38,4)")
    model = days.groupBy(*SERIES).agg(
        F.sum("rows").alias("series_rows"), F.sum("n_train").alias("n_train"), F.sum("n").alias("n"),
        *[F.coalesce(F.sum(c), zero).cast("decimal(38,4)").alias(c) for c in ("st", "stt", "sy", "sty")],
        F.max("train_end").alias("train_end"), F.max("series_end").alias("series_end"),
        F.collect_list(F.struct("dow", "n", F.col("st").alias("t"), F.col("sy").alias("y"))).alias("days"),
        F.flatten(F.collect_list("tail")).alias("tail"))
    n = F.col("n").cast("decimal(14,0)")
    exact = lambda c: F.col(c).cast("decimal(22,4)")
    sxx = (n * exact("stt") - exact("st") * exact("st")).cast("double")
    model = model.withColumn("sxx", sxx).filter(
        (F.col("series_rows") >= min_rows) & (F.col("n_train") >= 2) & (F.col("sxx") > 0))
    model = model.withColumn("b", (n * exact("sty") - exact("st") * exact("sy")).cast("double") / F.col("sxx"))
    model = model.withColumn("a", (F.col("sy").cast("double") - F.col("b") * F.col("st").cast("double")) / F.col("n"))
    known = F.filter("days", lambda d: d["dow"].isNotNull())
    effect = F.map_from_entries(F.transform(known, lambda d: F.struct(d["dow"], F.coalesce(
        (d["y"].cast("double") - F.col("b") * d["t"].cast("double")) / F.nullif(d["n"], F.lit(0)) - F.col("a"),
        F.lit(0.0)))))
    model = model.withColumn("weekday_effect", effect)
    fitted = lambda r: F.col("a") + F.col("b") * r["t"] + F.coalesce(
        F.try_element_at("weekday_effect", r["dow"]), F.lit(0.0))
    return model.select(
        *SERIES, "a", "b", "weekday_effect", "train_end", "series_end", "n_train", "series_rows",
        F.transform("tail", lambda r: F.struct(r["y"].alias("y"), fitted(r).alias("yhat"))).alias("tail"))


def trend_weekday_models(fitted: DataFrame) -> DataFrame:
    """One row per series: a, b, weekday effects (map), training end, series end and half the width of its bounds.

    The bounds are split-conformal: the hold-out rows' absolute errors in order, the one of rank
    ceil((n + 1) * level).  Fewer than 19 of them cannot carry 95 %; then the
    largest is taken, whose coverage is n / (n + 1).
    """
    errors = F.array_sort(F.filter(F.transform("tail", lambda r: F.abs(r["y"] - r["yhat"])), lambda e: e.isNotNull()))
    n = F.size("errors")
    rank = F.least(n, F.ceil((n + 1) * F.lit(BOUND_LEVEL)).cast("int"))
    return fitted.withColumn("errors", errors).select(
        *SERIES, "a", "b", "weekday_effect", "train_end", "series_end", "n_train",
        F.get("errors", rank - 1).alias("half_width"))


def holdout_errors(fitted: DataFrame) -> DataFrame:
    """M8: per-series MAE and MAPE on the held-out rows (zero actuals excluded from MAPE)."""
    hold = fitted.select(*SERIES, "n_train", F.explode("tail").alias("r")).select(*SERIES, "n_train", "r.*")
    err = F.abs(F.col("y") - F.col("yhat"))
    return hold.groupBy(*SERIES).agg(
        F.avg(err).alias("mae"),
        F.avg(err / F.nullif(F.col("y"), F.lit(0.0))).alias("mape"),
        F.count(F.lit(1)).alias("n_holdout"),
        F.first("n_train").alias("n_train"),
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """Mean MAE / MAPE over series with a model and the model count; 0.0 when none."""
    return errors.agg(
        F.coalesce(F.avg("mae"), F.lit(0.0)).alias("mae_mean"),
        F.coalesce(F.avg("mape"), F.lit(0.0)).alias("mape_mean"),
        F.count(F.lit(1)).alias("n_models"),
    )


def forecast_daily(models: DataFrame, horizon_days: int = 14, anchor: str = "series_end") -> DataFrame:
    """M9: one row per series and day 1..horizon after the anchor (the series' or the training rows' last date).

    The bounds are the forecast plus and minus the series' half width (`trend_weekday_models`).
    """
    if anchor not in ("series_end", "train_end"):
        raise ValueError("anchor must be 'series_end' or 'train_end'")
    steps = models.select(*SERIES, "a", "b", "weekday_effect", "half_width", F.col(anchor).alias("anchor"),
                          F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("step"))
    d = F.date_add(F.col("anchor"), F.col("step"))
    yhat = F.col("a") + F.col("b") * _days(d) + F.coalesce(F.try_element_at("weekday_effect", F.weekday(d)), F.lit(0.0))
    half = F.col("half_width")
    return steps.select(*SERIES, "anchor", "step", d.alias("ds"), yhat.alias("yhat"), (yhat - half).alias("yhat_lower"),
                        (yhat + half).alias("yhat_upper"))


def forecast(models: DataFrame, horizon_days: int = 14, anchor: str = "series_end", bounds: bool = False) -> DataFrame:
    """M9: the published steps 7 and 14 (round 4), with the bounds of step 7 on request; a step beyond the horizon is NULL."""
    step = lambda k, c="yhat": F.round(F.max(F.when(F.col("step") == k, F.col(c))), 4)
    more = [step(7, c).alias(c) for c in ("yhat_lower", "yhat_upper")] if bounds else []
    return forecast_daily(models, horizon_days, anchor).groupBy(*SERIES, "anchor").agg(
        step(7).alias("yhat_7"), step(14).alias("yhat_14"), *more)


def fit_forecasts(history: DataFrame, lookback_days: int = 90, as_of=None, holdout: int = 14,
                  method: str = "trend_weekday", min_rows: int = 14):
    """M6 entry point: returns (per-series errors, model table or per-series forecasts)."""
    data = forecast_input(history, lookback_days, as_of)
    if method == "trend_weekday":
        fitted = fit_trend_weekday(data, holdout, min_rows)
        return holdout_errors(fitted), trend_weekday_models(fitted)
    if method == "change_points":
        from larder.operators import trend

        out = trend.change_point_forecasts(data, holdout, min_rows)
        return out.select(*SERIES, "mae", "mape", "n_holdout", "n_train"), out
    if method == "fourier":
        out = fourier_forecasts(data, holdout, min_rows)
        return out.select(*SERIES, "mae", "mape", "n_holdout", "n_train"), out
    raise ValueError(f"unknown method {method!r}")


# ---------------------------------------------------------------------------
# Fourier ridge per series (applyInPandas)
# ---------------------------------------------------------------------------

FOURIER_SCHEMA = ("item_id string, store_id string, n_train long, n_holdout long, mae double, mape double, "
                  "yhat_7 double, yhat_14 double, train_end date")


def _fourier_design(t: np.ndarray, t0: float, weekly: int, yearly: int) -> np.ndarray:
    cols = [np.ones_like(t), (t - t0) / 365.25]
    for k in range(1, weekly + 1):
        cols += [np.sin(2 * math.pi * k * t / 7.0), np.cos(2 * math.pi * k * t / 7.0)]
    for k in range(1, yearly + 1):
        cols += [np.sin(2 * math.pi * k * t / 365.25), np.cos(2 * math.pi * k * t / 365.25)]
    return np.column_stack(cols)


def _fourier_one(pdf: pd.DataFrame, holdout: int, min_rows: int, weekly: int = 3, yearly: int = 10,
                 ridge: float = 1.0) -> pd.DataFrame:
    """One series: training cells (a date's rows and their sum) and its held-out rows."""
    t, n, total, tail_t, y = split_cells(pdf)
    n_train = int(n.sum())
    if n_train + len(y) < min_rows or n_train < 2 or np.ptp(t) == 0:
        return pd.DataFrame(columns=[c.split()[0] for c in FOURIER_SCHEMA.split(", ")])
    x = _fourier_design(t, t[0], weekly, yearly)
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = penalty[1, 1] = 0.0
    coef = np.linalg.solve(x.T @ (n[:, None] * x) + penalty + 1e-9 * np.eye(x.shape[1]),
                           x.T @ total)
    err = np.abs(y - _fourier_design(tail_t, t[0], weekly, yearly) @ coef)
    with np.errstate(divide="ignore", invalid="ignore"):
        ape = np.where(y != 0, err / y, np.nan)
    fut = _fourier_design(t[-1] + np.array([7.0, 14.0]), t[0], weekly, yearly) @ coef
    return pd.DataFrame({
        "item_id": [pdf["item_id"].iloc[0]], "store_id": [pdf["store_id"].iloc[0]],
        "n_train": [n_train], "n_holdout": [len(y)],
        "mae": [float(err.mean())], "mape": [float(np.nanmean(ape)) if np.isfinite(ape).any() else None],
        "yhat_7": [round(float(fut[0]), 4)], "yhat_14": [round(float(fut[1]), 4)],
        "train_end": [(pd.Timestamp(EPOCH) + pd.Timedelta(days=int(t[-1]))).date()],
    })


def date_cells(df: DataFrame, holdout: int, hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """Day `t`, training rows `n`, their sum `y` and the held-out prices `tail`, per series and date.

    Dealt to as many tasks as a shuffle has: the cells are few, but what is fitted on them takes time.
    """
    rows = df.select(*SERIES, "price_date", TIEBREAK, F.col("regular_price").cast("double").alias("y"))
    rows = flag_holdout(rows, holdout, hot_series_rows).withColumn("t", _days(F.col("price_date")))
    train = ~F.col("is_holdout")
    cells = rows.groupBy(*SERIES, "t").agg(
        F.count(F.when(train, F.lit(1))).alias("n"), F.sum(F.when(train, F.col("y"))).alias("y"),
        F.sort_array(F.collect_list(F.when(~train, F.col("y")))).alias("tail"))
    return by_series(cells)


def by_series(cells: DataFrame) -> DataFrame:
    return cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), *SERIES)


def split_cells(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(t, n, y) of the cells with training rows, by day, and (t, y) of the held-out rows."""
    pdf = pdf.dropna(subset=["t"]).sort_values("t")
    used = pdf[pdf["n"] > 0]
    held = [(t, y) for t, tail in zip(pdf["t"], pdf["tail"], strict=True) for y in tail]
    tail = np.array(held, np.float64).reshape(-1, 2)
    return (*[used[c].to_numpy(np.float64) for c in ("t", "n", "y")], tail[:, 0], tail[:, 1])


def fourier_forecasts(df: DataFrame, holdout: int = 14, min_rows: int = 16,
                      hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """One ridge fit per series.

    All regressors depend on the date alone, so the training rows enter as one
    cell per date (partial aggregates); a series brings at most one cell per day
    of the lookback and its held-out rows to one task, however many rows it has.
    """
    return date_cells(df, holdout, hot_series_rows).groupBy(*SERIES).applyInPandas(
        lambda pdf: _fourier_one(pdf, holdout, max(min_rows, holdout + 2)), FOURIER_SCHEMA)


# ---------------------------------------------------------------------------
# M7: boosted residual model per series, on calendar cells
# ---------------------------------------------------------------------------

CALENDAR = (7, 6, 13)  # codes of day of week (0-6), week of month (1-5) and month (1-12)
RESIDUAL_SCHEMA = ("item_id string, store_id string, n_train long, n_holdout long, base double, effect array<double>, "
                   "mae double")


def residual_cells(history: DataFrame, lookback_days: int = 90, as_of=None, holdout: int = 14,
                   hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """Per series and (day of week, week of month, month): training rows, the sum of their day-over-day
    changes (exact), and the list of held-out changes (at most `holdout` a series)."""
    def flag(d: DataFrame, w) -> DataFrame:
        previous = F.coalesce(F.lag("regular_price").over(w), F.col("regular_price"))
        return d.withColumns({"change": F.col("regular_price") - previous,
                              "is_holdout": F.lead(F.lit(1), holdout).over(w).isNull()})

    rows = skew_safe_series_window(forecast_input(history, lookback_days, as_of), flag, before=1, after=holdout,
                                   hot_rows=hot_series_rows)
    train = ~F.col("is_holdout")
    return fe.calendar_features(rows).groupBy(*SERIES, "day_of_week", "week_of_month", "month").agg(
        F.count(F.when(train, F.lit(1))).alias("n"),
        F.coalesce(F.sum(F.when(train, F.col("change"))), F.lit(0)).cast("decimal(20,2)").alias("total"),
        F.array_sort(F.collect_list(F.when(~train, F.col("change").cast("double")))).alias("held_out"))


def _residual_one(pdf: pd.DataFrame, min_rows: int, rounds: int, depth: int, rate: float) -> pd.DataFrame:
    """One series from its cells (at most 7 x 5 x 12 of them, however many rows it has)."""
    names = [c.split()[0] for c in RESIDUAL_SCHEMA.replace("array<double>", "array").split(", ")]
    pdf = pdf.sort_values(["day_of_week", "week_of_month", "month"])
    n, held = pdf["n"].to_numpy(np.int64), pdf["held_out"].map(len).to_numpy()
    if n.sum() + held.sum() < min_rows or not n.sum():
        return pd.DataFrame(columns=names)
    codes = pdf[["day_of_week", "week_of_month", "month"]].to_numpy(np.int64)
    used = n > 0
    base, trees = boosting.fit_cells(codes[used], n[used], pdf["total"].astype(float).to_numpy()[used], CALENDAR,
                                     rounds, depth, rate)
    grid = np.stack(np.meshgrid(*[np.arange(k) for k in CALENDAR], indexing="ij"), -1).reshape(-1, 3)
    effect = base + sum((t.predict(grid) for t in trees), np.zeros(len(grid)))
    at = np.ravel_multi_index(codes.T, CALENDAR)
    errors = [abs(v - effect[k]) for k, values in zip(at, pdf["held_out"], strict=True) for v in values]
    return pd.DataFrame([(pdf["item_id"].iloc[0], pdf["store_id"].iloc[0], int(n.sum()), int(held.sum()), base,
                          effect.tolist(), float(np.mean(errors)) if errors else None)], columns=names)


def residual_models(cells: DataFrame, min_rows: int = 28, rounds: int = 50, depth: int = 3, rate: float = 0.1) -> DataFrame:
    """One boosted model per series of at least `min_rows` rows: `effect` is its prediction for every
    (day of week, week of month, month), so that scoring is a look-up (`residual_effect`)."""
    return by_series(cells.dropna(subset=["day_of_week"])).groupBy(*SERIES).applyInPandas(
        lambda pdf: _residual_one(pdf, min_rows, rounds, depth, rate), RESIDUAL_SCHEMA)


def residual_effect(effect: Column, date: Column) -> Column:
    """The model's change on a date."""
    at = (fe.day_of_week(date) * CALENDAR[1] + fe.week_of_month(date)) * CALENDAR[2] + F.month(date)
    return F.get(effect, at)


def residual_stage(history: DataFrame, lookback_days: int = 90, as_of=None, holdout: int = 14,
                   min_rows: int = 28, rounds: int = 50, depth: int = 3, rate: float = 0.1):
    """Second stage (M7): a boosted regression of the day-over-day change on calendar features for every series
    of at least `min_rows` rows, trained without its last `holdout` rows.  Returns (models, summary), without any
    such series (None, None)."""
    models = store(residual_models(residual_cells(history, lookback_days, as_of, holdout), min_rows, rounds, depth, rate),
                   "residual-models")
    if models.isEmpty():
        return None, None
    return models, models.agg(F.lit("residual_trees").alias("model"), F.count(F.lit(1)).alias("n_models"),
                              F.avg("mae").alias("holdout_mae"))
