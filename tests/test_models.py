"""Boosted trees, residual models, the ordered split and forecasts against fits by hand; reads per plan."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import boosting, classifier, features, forecast, marts
from larder.sources import fixtures as fx
from tests.conftest import SF_SMALL

COLS = ("a", "b", "c")


def labelled(n: int, seed: int) -> list[tuple]:
    r = random.Random(seed)
    rows = []
    for k in range(n):
        a, b, c = r.gauss(0, 1), r.choice([0.0, 1.0, 2.0, 3.0]), r.random()
        rows.append((a, b, c, int((a > 0.3 and b >= 2) or (c < 0.1 and r.random() < 0.8)), k % 5 == 0))
    return rows


def brute_boosting(rows, edges, rounds, depth, rate, weight):
    """Trees grown row by row over all cuts, without histograms; returns the training rows' margins."""
    x = np.array([r[:3] for r in rows])
    y = np.array([r[3] for r in rows], float)
    margin = np.zeros(len(rows))
    w = np.where(y == 1, weight, 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        step = np.zeros(len(rows))

        def grow(at, level):
            if level == depth:
                step[at] = -rate * g[at].sum() / (h[at].sum() + 1)
                return
            best, where = 1e-9 * max(1, abs(g[at].sum())), None
            for f in range(3):
                for e in edges[f]:
                    left, right = at[x[at, f] <= e], at[x[at, f] > e]
                    if h[left].sum() < 1 or h[right].sum() < 1:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - g[at].sum() ** 2 / (h[at].sum() + 1)
                    if gain > best * (1 + 1e-10):
                        best, where = gain, (left, right)
            for part in where or (at,):
                grow(part, level + 1 if where else depth)

        grow(np.arange(len(rows)), 0)
        margin += step
    return margin


@pytest.mark.parametrize("one_task", [0, 1 << 16])
def test_boosting_against_trees_grown_row_by_row(spark, one_task):
    rows = labelled(400, 1)
    df = spark.createDataFrame(rows, "a double, b double, c double, label int, out boolean").repartition(3)
    model = boosting.fit_boosted_trees(df, COLS, "label", F.col("out"), 6, 3, 0.3, positive_weight=2.5, patience=None,
                                       max_bins=16, one_task_cells=one_task)
    train = [r for r in rows if not r[4]]
    want = brute_boosting(train, model.edges, len(model.trees), 3, 0.3, 2.5)
    have = model.margin(model.codes(np.array([r[:3] for r in train])))
    assert len(model.trees) >= 4 and np.allclose(have, want, atol=1e-9)
    scored = classifier.score(model, df).collect()
    by_hand = 1 / (1 + np.exp(-model.margin(model.codes(np.array([[r["a"], r["b"], r["c"]] for r in scored])))))
    assert np.allclose([r["buy_now_probability"] for r in scored], by_hand)


def test_boosting_stops_by_the_held_out_rows_and_learns(spark):
    rows = labelled(3000, 2)
    df = spark.createDataFrame(rows, "a double, b double, c double, label int, out boolean")
    model = boosting.fit_boosted_trees(df, COLS, "label", F.col("out"), rounds=80, depth=4, rate=0.3, patience=5)
    assert len(model.trees) == int(np.argmin(model.held_out_loss)) and len(model.trees) < 80
    metrics = classifier.binary_metrics(classifier.score(model, df.filter("out")), "buy_now_probability", "label").first()
    assert metrics["auc_roc"] > Decimal("0.9")
    same = boosting.fit_boosted_trees(df.filter("label = 0"), COLS, "label", F.col("out"), rounds=3)
    assert len(same.held_out_loss) >= 1  # one class only: trees push the margin, nothing fails


def test_margins_stored_with_the_cells_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(labelled(200, 3), "a double, b double, c double, label int, out boolean")
    fit = lambda: boosting.fit_boosted_trees(df, COLS, "label", F.col("out"), 4, 2, 0.3, patience=None, one_task_cells=0)
    plain = fit()
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    stored = fit()
    for a, b in zip(plain.trees, stored.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)


def test_a_level_of_a_tree_is_one_stage_over_packed_cells(spark):
    df = spark.createDataFrame(labelled(2000, 4), "a double, b double, c double, label int, out boolean")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def stages(rounds):
        group = f"boosting-{rounds}"
        sc.setJobGroup(group, group)
        try:
            model = boosting.fit_boosted_trees(df, COLS, "label", F.col("out"), rounds, 3, 0.3, patience=None, one_task_cells=0)
        finally:
            sc._jsc.clearJobGroup()
        assert len(model.trees) >= 2
        return sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))

    assert stages(6) - stages(3) == 3 * 3  # three more trees of three levels


def test_splits_store_no_column_that_nothing_reads(spark):
    from larder.plans import catalog

    unread = {"item_name", "upc", "category", "store_name", "item_size", "promo_price"}
    history = marts.price_history(fx.fx_price(spark, SF_SMALL))
    assert unread <= set(history.columns)
    assert not unread & set(classifier.split_frame(history, 3650, fx.AS_OF).columns)
    assert not unread & set(catalog.stored_history(spark, SF_SMALL).columns)
    plan = catalog.QUERIES["ordered_split"](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert not any(f"{c}#" in plan for c in unread)


def test_classifier_trains_on_the_fixture(spark):
    history = marts.price_history(fx.fx_price(spark, SF_SMALL))
    model, metrics = classifier.train_classifier(history, 3650, fx.AS_OF, rounds=8)
    found = metrics.first()
    assert 0 < len(model.trees) <= 8 and all(0 <= found[c] <= 1 for c in ("precision", "recall", "f1", "auc_roc"))
    assert classifier.train_classifier(history, 3650, fx.AS_OF, split="time", rounds=2)[0] is not None
    assert classifier.train_classifier(history.limit(0), 90, fx.AS_OF) == (None, None)


def test_classifier_grows_all_its_trees_over_the_whole_history(spark, monkeypatch):
    from larder.plans import catalog

    r = random.Random(6)
    rows = [(f"i{k}", "s", dt.date(2015 + 5 * (k % 2), 1, 1) + dt.timedelta(days=d), f"{d:04d}", Decimal(r.choice([8, 10])),
             r.random() < 0.5) for k in range(5) for d in range(60)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, price_date date, load_id string, "
                                     "regular_price decimal(10,2), is_on_sale boolean")
    history = marts.price_history(df)
    assert classifier.split_frame(history).count() == 5 * (60 - 7)  # years before any lookback too
    model, _ = classifier.train_classifier(history, rounds=40, rate=0.5)
    loss = model.held_out_loss
    assert int(np.argmin(loss)) < 30 and loss[-1] > min(loss)  # by noise: the held-out rows would have stopped it
    assert len(model.trees) == 40

    frames, fit = [], boosting.fit_boosted_trees
    monkeypatch.setattr(boosting, "fit_boosted_trees", lambda rows, *a, **k: frames.append(rows) or fit(
        rows, *a[:3], 2, *a[4:], **k))
    assert catalog.QUERIES["train_classifier_metrics"](spark, SF_SMALL).count() == 1
    labels = features.build_labels(catalog.stored_history(spark, SF_SMALL)).count()
    assert frames[0].count() == labels > 4000


def daily(spark, prices: list[float], item: str = "i", store: str | None = "s"):
    rows = [(item, store, dt.date(2024, 1, 1) + dt.timedelta(days=k), f"{k:05d}", Decimal(f"{p:.2f}"), False)
            for k, p in enumerate(prices)]
    return spark.createDataFrame(rows, "item_id string, store_id string, price_date date, load_id string, "
                                       "regular_price decimal(10,2), is_on_sale boolean")


def test_residual_models_against_a_fit_by_hand(spark):
    r = random.Random(4)
    prices = np.cumsum([r.choice([-0.5, 0.25, 1.0]) + (2 if k % 7 == 0 else -0.3) for k in range(200)]) + 100
    df = daily(spark, prices.tolist()).unionByName(daily(spark, [1.0] * 27, "short"))
    got = forecast.residual_models(forecast.residual_cells(df, 3650, "2024-12-31"), rounds=5).collect()
    assert [(r["item_id"], r["n_train"], r["n_holdout"]) for r in got] == [("i", 186, 14)]
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(200)]
    x = np.array([(d.weekday(), (d.day - 1) // 7 + 1, d.month) for d in dates])
    y = np.round(np.diff(np.round(prices, 2), prepend=round(prices[0], 2)), 2)
    train, pred = np.arange(186), np.full(200, y[:186].mean())
    for _ in range(5):
        g = pred - y

        def grow(at, everyone, level):
            if level < 3:
                best, where = 1e-9, None
                for f in range(3):
                    for cut in range(13):
                        left = at[x[at, f] <= cut]
                        right = at[x[at, f] > cut]
                        if not len(left) or not len(right):
                            continue
                        gain = sum(g[s].sum() ** 2 / (len(s) + 1) for s in (left, right)) - g[at].sum() ** 2 / (len(at) + 1)
                        if gain > best * (1 + 1e-10):
                            best, where = gain, (f, cut)
                if where:
                    for side in (x[:, where[0]] <= where[1], x[:, where[0]] > where[1]):
                        grow(at[side[at]], everyone[side[everyone]], level + 1)
                    return
            step[everyone] = -0.1 * g[at].sum() / (len(at) + 1)

        step = np.zeros(200)
        grow(train, np.arange(200), 0)
        pred = pred + step
    effect = np.array(got[0]["effect"]).reshape(forecast.CALENDAR)
    assert np.allclose(effect[tuple(x.T)], pred, atol=1e-9)
    assert got[0]["mae"] == pytest.approx(np.abs(y[186:] - pred[186:]).mean())
    looked_up = df.filter("item_id = 'i'").select("price_date", forecast.residual_effect(
        F.array(*[F.lit(float(v)) for v in got[0]["effect"]]), F.col("price_date")).alias("e")).orderBy("price_date").collect()
    assert np.allclose([r["e"] for r in looked_up], pred, atol=1e-9)


def test_ordered_split_keeps_rows_with_null_keys(spark):
    rows = [(i, s, dt.date(2024, 1, 1 + k % 20), f"{k:04d}") for k, (i, s) in enumerate(
        [("a", "x"), ("a", None), (None, "x"), (None, None), ("b", "y")] * 20)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, price_date date, load_id string")
    got = features.ordered_split(df, partitions=7).collect()
    want = sorted(rows, key=lambda r: tuple((v is not None, v or "") for v in (r[0], r[1])) + (r[2], r[3]))
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: r["row_index"])] == want
    assert [r["row_index"] for r in sorted(got, key=lambda r: r["row_index"])] == list(range(100))
    assert {r["row_index"] for r in got if r["split"] == "test"} == set(range(80, 100))
    assert features.ordered_split(df.limit(0)).count() == 0


def test_episodes_of_series_without_a_store(spark):
    df = daily(spark, [5.0] * 12, store=None).unionByName(daily(spark, [5.0] * 12)).withColumns(
        {"is_on_sale": F.dayofmonth("price_date") % 4 == 0, "promo_price": F.col("regular_price")})
    got = marts.promo_calendar_episodes(df).collect()
    assert sorted((r["store_id"] or "", r["episode"]) for r in got) == [("", 1), ("", 2), ("", 3), ("s", 1), ("s", 2), ("s", 3)]


def test_forecast_bounds_are_order_statistics_of_hold_out_errors(spark):
    r = random.Random(8)
    df = daily(spark, [50 + r.uniform(-5, 5) for _ in range(130)])
    for holdout in (10, 40):
        fit = forecast.fit_trend_weekday(forecast.forecast_input(df, 3650, "2024-12-31"), holdout)
        errors = sorted(abs(t["y"] - t["yhat"]) for t in fit.first()["tail"])
        day = forecast.forecast_daily(forecast.trend_weekday_models(fit), 3).collect()
        rank = min(holdout, int(np.ceil((holdout + 1) * 0.95)))
        for d in day:
            assert d["yhat_upper"] - d["yhat"] == pytest.approx(errors[rank - 1]) == pytest.approx(d["yhat"] - d["yhat_lower"])
        assert sum(e <= errors[rank - 1] for e in errors) >= min(holdout, 0.95 * holdout)


#: Scans of the fixture's tables in the plan, over those of one reading: the rows, the count per series, and the
#: key columns of hot series' rows; transitions that carry values between chunks read twice as often.
@pytest.mark.parametrize("name,readings", [("price_history", 3), ("build_labels", 3), ("sale_transitions", 3),
                                           ("forecast_error_summary", 3), ("attach_forecasts", 6), ("residual_cells", 3),
                                           ("holdout_tail", 3), ("sale_ends", 7), ("promo_calendar_episodes", 7)])
def test_plans_do_not_multiply_their_input(spark, name, readings):
    from larder.plans import catalog

    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    once = scans(catalog.sales(spark, SF_SMALL))
    df = catalog.QUERIES[name](spark, SF_SMALL)
    assert scans(df) <= readings * once
    df.collect()  # no series is hot: adaptive execution drops the branches of hot ones
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") <= (2 if name != "attach_forecasts" else 4) * once


def test_change_points_recover_a_planted_break(spark):
    from larder.operators import trend

    t = np.arange(200)
    line = 20 + 0.02 * t + 0.15 * np.maximum(t - 80, 0) + 0.3 * np.sin(2 * np.pi * (t + 0) / 7)
    df = daily(spark, line.tolist()).unionByName(daily(spark, (20 + 0.02 * t).tolist(), "straight")).unionByName(
        daily(spark, [1.0] * 10, "short"))
    _, out = forecast.fit_forecasts(df, 3650, "2024-12-31", method="change_points")
    got = {r["item_id"]: r for r in out.collect()}
    assert set(got) == {"i", "straight"} and got["i"]["n_train"] == 186 and got["i"]["n_holdout"] == 14
    day = lambda d: (d - dt.date(2024, 1, 1)).days
    near = [c["delta"] for c in got["i"]["changes"] if 65 <= day(c["ds"]) <= 95]
    assert sum(near) == pytest.approx(0.15, abs=0.04) and max(abs(c["delta"]) for c in got["i"]["changes"]) in map(abs, near)
    assert got["i"]["yhat_14"] == pytest.approx(line[-1], abs=1.0) and sum(abs(c["delta"]) for c in got["straight"]["changes"]) < 0.01
    # the solution meets the optimality conditions of its objective, and is least squares without penalties
    x, y = trend.design(t.astype(float), 0.0, 199.0, trend.change_point_days(t.astype(float))), line
    gram, moment, ridge = x.T @ x / 200, x.T @ y / 200, np.r_[np.zeros(27), np.full(6, 1e-3)]
    bends = np.arange(2, 27)
    for penalty in (1e-4, 1e-2):
        b = trend.penalised_fit(gram, moment, ridge, bends, penalty)
        slope = gram @ b - moment + ridge * b
        assert np.abs(np.delete(slope, bends)).max() < 1e-8
        assert all(abs(s + penalty * np.sign(v)) < 1e-7 if v else abs(s) <= penalty + 1e-9 for s, v in zip(slope[bends], b[bends], strict=True))
    free = trend.penalised_fit(gram, moment, ridge, np.array([], int), 0.0)
    assert np.allclose(free, np.linalg.solve(gram + np.diag(ridge), moment), atol=1e-6)


def full_regression(rows: list[tuple], event: dt.date):
    """The whole dummy regression, by pseudo-inverse: (effect, HC1 error or None)."""
    stores, dates = sorted({r[2] for r in rows}), sorted({r[4] for r in rows})
    x = np.array([[1.0, r[3] == "IA", r[4] >= event, r[3] == "IA" and r[4] >= event, *[r[2] == s for s in stores[1:]],
                   *[r[4] == d for d in dates[1:]]] for r in rows], float)
    y = np.array([float(r[5]) for r in rows])
    inv = np.linalg.pinv(x)
    beta, n, k = inv @ y, len(y), np.linalg.matrix_rank(x)
    e = y - x @ beta
    return beta[3], None if n <= k else np.sqrt((inv[3] ** 2 @ e ** 2) * n / (n - k))


@pytest.mark.parametrize("kind", ["identified", "treated after only", "all treated", "none treated", "mixed"])
def test_did_is_the_minimum_norm_solution(spark, kind):
    from larder.operators import causal

    rnd, event, rows = random.Random(3), dt.date(2024, 2, 1), []
    for s in range(7):
        state = "IA" if kind == "all treated" or (s in (0, 2, 5) and kind != "none treated") else "TX"
        for d in range(-9, 12):
            if state == "IA" and d < 0 and (kind == "treated after only" or (kind == "mixed" and s != 0)):
                continue
            if kind == "mixed" and s == 0 and d >= 0:
                continue
            for _ in range(rnd.choice([0, 1, 2, 2])):
                rows.append((f"L{len(rows)}", "A", f"S{s}", state, event + dt.timedelta(days=d),
                             Decimal(f"{5 + s * 0.3 + d * 0.05 + rnd.uniform(-1, 1):.2f}"), "Eggs"))
    df = spark.createDataFrame(rows, "load_id string, item_id string, store_id string, store_state string, "
                                     "price_date date, regular_price decimal(10,2), category string")
    got = causal.did(df, "e", "2024-02-01", ["IA"], "Eggs", 4).first()
    att, se = full_regression(rows, event)
    assert got["att"] == pytest.approx(att, abs=6e-5)
    assert got["n_obs"] == len(rows) and got["n_treated_stores"] + got["n_control_stores"] == 7
    if kind == "none treated":
        assert got["se"] is None
    else:
        assert got["se"] == pytest.approx(se, abs=2e-6)


def test_two_stage_least_squares_against_numpy(spark):
    from larder.operators import causal

    r = np.random.Generator(np.random.PCG64(5))
    z, w, u = r.standard_normal((300, 2)), r.standard_normal(300), r.standard_normal(300)
    x = z @ [0.8, -0.5] + 0.4 * w + u + r.standard_normal(300) * 0.2
    y = 1 + 2 * x - 0.7 * w + 1.5 * u * (1 + np.abs(z[:, 0]))
    rows = [(float(a), float(b), float(c), float(d), float(e)) for a, b, (c, d), e in zip(y, x, z, w, strict=True)]
    df = spark.createDataFrame([*rows, (1.0, None, 1.0, 1.0, 1.0)], "y double, x double, z1 double, z2 double, w double")
    got = {t["term"]: t for t in causal.two_stage_least_squares(df, "y", ["x"], ["z1", "z2"], ("w",)).collect()}
    xs, zs = np.column_stack([np.ones(300), w, x]), np.column_stack([np.ones(300), w, z])
    hat = zs @ np.linalg.lstsq(zs, xs, rcond=None)[0]
    inv = np.linalg.inv(hat.T @ xs)
    beta = inv @ hat.T @ y
    e = y - xs @ beta
    se = np.sqrt(np.diag(inv @ (hat.T * e ** 2) @ hat @ inv.T))
    for k, name in enumerate(("const", "w", "x")):
        assert got[name]["coefficient"] == pytest.approx(beta[k]) and got[name]["se"] == pytest.approx(se[k])
        assert got[name]["n"] == 300
    with pytest.raises(ValueError):
        causal.two_stage_least_squares(df, "y", ["x", "w"], ["z1"])
    assert causal.two_stage_least_squares(df.limit(2), "y", ["x"], ["z1"]).count() == 0


def test_compressed_promo_ranges(spark):
    from collections import Counter

    from tests.test_estimators import crowded_series

    df = crowded_series(spark, [10] * 12 + [60] + [3] * 10, odd=True)
    for make in (marts.promo_calendar_range, marts.promo_calendar_links, marts.promo_calendar_ends):
        plain, split = (Counter(map(str, make(df, hot_series_rows=k).collect())) for k in (None, 40))
        assert plain == split and plain
    links = marts.promo_calendar_links(df)
    assert links.agg(F.sum(F.greatest("n_ends", F.lit(1)))).first()[0] == marts.promo_calendar_range(df).count()
    few = links.filter("sale_start_date < '2024-01-03'")
    some = marts.expand_links(few, marts.promo_calendar_ends(df))
    want = marts.promo_calendar_range(df).filter("sale_start_date < '2024-01-03'")
    assert some.exceptAll(want).count() == 0 and some.count() == want.count() > few.count()


def test_promo_range_shuffles_no_joined_row(spark, monkeypatch):
    from collections import Counter

    from tests.test_estimators import crowded_series

    df = crowded_series(spark, [10] * 12 + [60] + [3] * 10, odd=True)
    links, ends = marts.promo_calendar_links(df).localCheckpoint(), marts.promo_calendar_ends(df).localCheckpoint()
    rows = lambda: Counter(map(str, marts.expand_links(links, ends).collect()))
    want = rows()
    plan = marts.expand_links(links, ends)._jdf.queryExecution().optimizedPlan().toString()
    exploded = plan.split("Join LeftOuter", 1)[1]
    assert "sequence(first_end_rank" not in exploded  # a start does not come once per end
    for name in ("TILE_ENDS", "TILE_STARTS"):
        monkeypatch.setattr(marts, name, 3)
    assert rows() == want and sum(want.values()) > 2 * links.count()


def test_promo_range_reads_the_history_once_and_its_windows_are_linear(spark, monkeypatch):
    from collections import Counter

    from tests.test_estimators import crowded_series

    df, made, calls = crowded_series(spark, [10] * 12 + [60] + [3] * 10), marts._sale_marks, []
    monkeypatch.setattr(marts, "_sale_marks", lambda *a: calls.append(a) or made(*a))
    rows = marts.promo_calendar_range(df)
    assert len(calls) == 1  # starts and ends are marks of one reading
    assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()  # few bytes, but many joined rows
    plan = made(df, "load_id", None)._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame" in plan and "RowFrame, 1, unboundedfollowing" not in plan  # added up anew for each mark
    s, e = marts.sale_starts(marts.sale_transitions(df)), marts.sale_ends(df)
    e = e.select(F.col("item_id").alias("i"), F.col("store_id").alias("s"), "last_promo_date", "sale_end_date")
    want = s.join(e, F.expr("item_id = i AND store_id = s AND last_promo_date >= sale_start_date"), "left")
    cols = ("item_id", "store_id", "sale_start_date", "sale_end_date")
    assert Counter(rows.select(*cols).collect()) == Counter(want.select(*cols).collect())


def test_append_once_and_backfill_are_repeatable(spark, tmp_path):
    from larder.plans import catalog, jobs
    from larder.sources import documents, ingest

    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("b", "2024-01-01"), ("c", None)],
                                 "load_id string, day string")
    path = f"{tmp_path}/t"
    assert [ingest.append_once(rows, path, partition_col="day") for _ in range(3)] == [3, 0, 0]
    assert ingest.append_once(rows.filter("load_id = 'a'").withColumn("load_id", F.lit("d")), path, partition_col="day") == 1
    assert ingest.append_once(rows, path, partition_col="day", dry_run=True) == 0 and spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        ingest.append_once(rows.withColumn("load_id", F.lit(None).cast("string")), path)
    items = documents.crowd_items(fx.fx_price(spark, SF_SMALL)).withColumn("code", F.col("product_id")).drop("product_id", "upc")
    pages = documents.crowd_pages(items, "code", 100)
    run = lambda: jobs.job_backfill(spark, catalog.raw_prices(spark, SF_SMALL), pages, 365, catalog.BACKFILL_AS_OF, False,
                                    out_path=f"{tmp_path}/b").first()["rows"]
    first = run()
    assert first > 0 and run() == 0 and spark.read.parquet(f"{tmp_path}/b").count() == first


def test_stream_keeps_documents_without_ids_apart(spark, tmp_path):
    from larder.streaming import landing_stream

    docs = spark.createDataFrame([(None, None, f"s{k % 3}", "p", '{"n": %d}' % k) for k in range(5)],
                                 landing_stream.DOC_SCHEMA)
    spark.createDataFrame([], landing_stream.TABLE_SCHEMA).write.partitionBy("load_part").parquet(f"{tmp_path}/t")
    for _ in range(2):
        landing_stream.land_batch(docs, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_curve_clustering_narrows_every_column(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from larder.sources import ingest

    rows = fx.fx_price(spark, SF_SMALL).select("load_id", "item_id", "store_id", "price_date")
    odd = rows.limit(3).withColumns({"item_id": F.lit(None).cast("string"), "store_id": F.lit(None).cast("string")})
    rows = rows.unionByName(odd)
    sorted_, curve = f"{tmp_path}/sorted", f"{tmp_path}/curve"
    rows.repartitionByRange(16, "item_id", "store_id", "price_date").sortWithinPartitions(
        "item_id", "store_id", "price_date").write.parquet(sorted_)
    ingest.write_curve_clustered(rows, curve, ["item_id", "store_id", "price_date"], files=16)
    assert spark.read.parquet(curve).exceptAll(rows).count() == 0 and spark.read.parquet(curve).count() == rows.count()

    def touched(path: str, column: str, value) -> float:
        """The share of row groups whose range of the column holds the value."""
        groups = hit = 0
        for f in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                stats = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns)
                             if meta.row_group(g).column(c).path_in_schema == column)
                groups += 1
                hit += stats.min <= value <= stats.max
        return hit / groups

    day = dt.date(1997, 3, 1)
    assert touched(sorted_, "store_id", "S3") > 0.8 and touched(sorted_, "price_date", day) > 0.8
    for column, value in (("store_id", "S3"), ("item_id", "Brand#12"), ("price_date", day)):
        assert touched(curve, column, value) <= 0.65, column
    with pytest.raises(ValueError):
        ingest.write_curve_clustered(rows, curve, ["item_id"], bits=63)
