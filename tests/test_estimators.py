"""Estimators against direct numpy regressions on small panels, plus the distribution helpers."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest

from larder.functions import stats
from larder.operators import causal, marts
from larder.sources import fixtures as fx
from larder.sources.tables import SPREAD_CONF, read_table
from tests.conftest import SF_SMALL


def test_student_and_normal_tails():
    assert stats.student_t_two_sided_p(2.0, 10) == pytest.approx(0.073388, abs=1e-6)
    assert stats.student_t_two_sided_p(0.0, 5) == pytest.approx(1.0)
    assert stats.normal_two_sided_p(1.959963984540054) == pytest.approx(0.05, abs=1e-12)


def _panel(seed: int):
    rnd = random.Random(seed)
    ev = dt.date(2024, 2, 1)
    rows = []
    for s in range(9):
        state = "IA" if s < 3 else "TX"
        for d in range(-28, 29):
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                day = ev + dt.timedelta(days=d)
                effect = 0.7 if (s < 3 and d >= 0) else 0.0
                y = round(2 + 0.1 * s + 0.01 * d + effect + rnd.gauss(0, 0.3), 2)
                rows.append((f"L{len(rows)}", "A", f"S{s}", state, day, Decimal(str(y)), "Eggs"))
    return rows


def test_did_matches_dummy_regression_hc1(spark):
    rows = _panel(5)
    hist = spark.createDataFrame(rows, "load_id string, item_id string, store_id string, store_state string, "
                                       "price_date date, regular_price decimal(10,2), category string")
    got = causal.did(hist, "e", "2024-02-01", ["IA"], "Eggs", 4).first()

    stores = sorted({r[2] for r in rows})
    dates = sorted({r[4] for r in rows})
    x = np.zeros((len(rows), 1 + len(stores) + len(dates)))
    y = np.array([float(r[5]) for r in rows])
    for i, r in enumerate(rows):
        x[i, 0] = 1.0 if (r[3] == "IA" and r[4] >= dt.date(2024, 2, 1)) else 0.0
        x[i, 1 + stores.index(r[2])] = 1.0
        x[i, 1 + len(stores) + dates.index(r[4])] = 1.0
    xtx_inv = np.linalg.pinv(x.T @ x)
    beta = xtx_inv @ x.T @ y
    e = y - x @ beta
    n, k = len(y), np.linalg.matrix_rank(x)
    v = xtx_inv @ (x.T * e ** 2) @ x @ xtx_inv * n / (n - k)
    assert got.att == pytest.approx(round(beta[0], 4), abs=1e-9)
    assert got.se == pytest.approx(round(math.sqrt(v[0, 0]), 6), abs=1e-9)
    assert got.n_treated_stores == 3 and got.n_control_stores == 6 and got.n_obs == n


def test_rdd_matches_interacted_ols_hc3(spark):
    rnd = random.Random(11)
    data = [(x, rnd.random() < 0.3 + 0.02 * x + (0.2 if x >= 0 else 0)) for x in
            [rnd.randint(-7, 7) for _ in range(400)]]
    got = causal.local_linear_rdd(spark.createDataFrame(data, "running_var int, is_on_sale boolean")).first()
    xs = np.array([float(a) for a, _ in data])
    ys = np.array([1.0 if b else 0.0 for _, b in data])
    above = (xs >= 0).astype(float)
    x = np.column_stack([np.ones_like(xs), xs, above, xs * above])
    xtx_inv = np.linalg.inv(x.T @ x)
    beta = xtx_inv @ x.T @ ys
    e = ys - x @ beta
    h = np.einsum("ij,jk,ik->i", x, xtx_inv, x)
    v = xtx_inv @ (x.T * (e / (1 - h)) ** 2) @ x @ xtx_inv
    assert got.jump == pytest.approx(beta[2], abs=1e-10)
    assert got.se == pytest.approx(math.sqrt(v[2, 2]), abs=1e-10)


def test_hot_series_split_equals_plain_window(spark):
    p = fx.fx_price(spark, SF_SMALL)
    plain = marts.price_history(p, hot_series_rows=None)
    split = marts.price_history(p, hot_series_rows=95)  # forces several series through the chunked path
    cols = plain.columns
    assert plain.select(*cols).exceptAll(split.select(*cols)).count() == 0
    assert split.select(*cols).exceptAll(plain.select(*cols)).count() == 0


def test_hot_series_split_for_lag_and_lead_windows(spark):
    from larder.operators import features

    p = fx.fx_price(spark, SF_SMALL)
    for plain, split in [
        (marts.sale_transitions(p, hot_series_rows=None), marts.sale_transitions(p, hot_series_rows=10)),
        (features.build_labels(p, hot_series_rows=None), features.build_labels(p, hot_series_rows=10)),
        (marts.promo_calendar_episodes(p, hot_series_rows=None), marts.promo_calendar_episodes(p, hot_series_rows=10)),
    ]:
        cols = plain.columns
        assert plain.select(*cols).exceptAll(split.select(*cols)).count() == 0
        assert split.select(*cols).exceptAll(plain.select(*cols)).count() == 0


def test_forecaster_hot_path_equals_plain(spark):
    from larder.operators import forecast

    data = forecast.forecast_input(fx.fx_price(spark, SF_SMALL), 3650, "2001-11-04")
    plain = forecast.holdout_errors(forecast.fit_trend_weekday(data, hot_series_rows=None))
    split = forecast.holdout_errors(forecast.fit_trend_weekday(data, hot_series_rows=20))
    a = {(r.item_id, r.store_id): (round(r.mae, 9), r.n_holdout, r.n_train) for r in plain.collect()}
    b = {(r.item_id, r.store_id): (round(r.mae, 9), r.n_holdout, r.n_train) for r in split.collect()}
    assert a == b and len(a) > 0


def test_holdout_tail_hot_path_equals_plain(spark):
    from larder.operators import forecast

    data = forecast.forecast_input(fx.fx_price(spark, SF_SMALL), 3650, "2001-11-04")
    cols = ["item_id", "store_id", "price_date", "load_id", "rn_desc", "series_rows", "is_holdout"]
    plain = forecast.holdout_tail(data, hot_series_rows=None).select(*cols)
    split = forecast.holdout_tail(data, hot_series_rows=20).select(*cols)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_spread_scans_keep_rows(spark):
    df = read_table(spark, SF_SMALL, "lineitem")
    spark.conf.set(SPREAD_CONF, "true")
    try:
        spread = read_table(spark, SF_SMALL, "lineitem")
    finally:
        spark.conf.unset(SPREAD_CONF)
    assert "Exchange" in spread._jdf.queryExecution().toString() and "Exchange" not in df._jdf.queryExecution().toString()
    assert spread.exceptAll(df).count() == 0 and df.exceptAll(spread).count() == 0


def crowded_series(spark, sizes: list[int], odd: bool = False):
    """One series whose dates have these many rows, and a short second one."""
    rows, k = [], 0
    for day, n in enumerate(sizes):
        for _ in range(n):
            rows.append(("A", "s", dt.date(2024, 1, 1) + dt.timedelta(days=day), f"{k * 7919 % 100003:06d}",
                         Decimal(k * 37 % 101) / 10 + 1, k % 5 in (1, 2)))
            k += 1
    rows += [("B", "s", dt.date(2024, 1, 1) + dt.timedelta(days=d), f"{d:06d}", Decimal(d + 1), d % 3 == 0) for d in range(40)]
    if odd:
        rows += [("A", "s", None, "x", Decimal(3), False), (None, "s", dt.date(2024, 1, 1), "y", Decimal(3), True)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, price_date date, load_id string, "
                                     "regular_price decimal(10,2), is_on_sale boolean")
    return df.withColumn("promo_price", df.regular_price)


@pytest.mark.parametrize("sizes,chunks", [([60, 35, 95, 15, 60], (100, 92)), ([10] * 30 + [350] + [10] * 3, (100, 400)),
                                          ([1] * 400, (92, 137)), ([300], (95,))])
def test_chunks_equal_plain_windows_whatever_the_dates(spark, sizes, chunks):
    """Dates longer than a chunk, and chunks about as short as the windows reach."""
    from larder.operators import features, forecast

    df = crowded_series(spark, sizes, odd=True)
    for f in (marts.price_history, marts.sale_transitions, marts.sale_ends, marts.days_between_sales,
              marts.promo_calendar_episodes, features.build_labels, forecast.residual_target, forecast.holdout_tail):
        plain = f(df, hot_series_rows=None)
        want = Counter(plain.collect())
        for chunk in chunks:
            assert Counter(f(df, hot_series_rows=chunk).select(*plain.columns).collect()) == want, (f.__name__, chunk)


def test_ordered_split_of_hot_series(spark):
    from larder.operators import features

    df = crowded_series(spark, [10] * 30 + [350])
    plain, split = (features.ordered_split(df, partitions=k).select("load_id", "row_index", "split") for k in (1, 50))
    assert plain.exceptAll(split).count() == 0 and plain.count() == split.count() == 690


def test_fourier_of_hot_series(spark):
    from larder.operators import forecast

    df = crowded_series(spark, [5] * 60)
    plain, split = (forecast.fourier_forecasts(df, hot_series_rows=k).orderBy("item_id").collect() for k in (None, 50))
    assert [(r.item_id, r.n_train, r.n_holdout, r.train_end) for r in plain] == [
        ("A", 286, 14, dt.date(2024, 2, 27)), ("B", 26, 14, dt.date(2024, 1, 26))]
    assert [round(r.mae, 6) for r in plain] == [round(r.mae, 6) for r in split]


def test_plans_are_built_without_jobs(spark):
    """Queries that write nothing, train nothing and pivot nothing start no job before their action."""
    from larder.plans import catalog

    tracker = spark.sparkContext.statusTracker()
    for name in ("price_history", "promo_calendar_episodes", "dq_not_null", "build_labels", "sale_ends",
                 "forecast_trend_weekday", "external_signals", "lagged_signal_join", "binary_metrics"):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        try:
            catalog.QUERIES[name](spark, SF_SMALL)
            stages = [tracker.getStageInfo(k) for j in tracker.getJobIdsForGroup(f"plan-{name}")
                      for k in tracker.getJobInfo(j).stageIds]
            # a parquet reader looks at a file's footer for its schema; nothing else may run
            assert {s.name.split(" at ")[0] for s in stages if s} <= {"parquet"}, name
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
