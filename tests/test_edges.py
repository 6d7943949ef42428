"""Hand-written edge rows (FIXTURES.md §3), one test per decision."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.operators import causal, classifier, features, marts, staging
from larder.sources import ingest

D = dt.date


def _raw_prices(spark, payloads, store="S1"):
    rows = [(f"L{i}", dt.datetime(2025, 1, 1 + i), store, "P", json.dumps(p) if not isinstance(p, str) else p)
            for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "load_id string, loaded_at timestamp_ntz, store_id string, product_id string, "
                                     "payload string")
    return df.select("load_id", "loaded_at", "store_id", "product_id", F.parse_json("payload").alias("raw_payload"))


def _stores(spark):
    return spark.createDataFrame([("S1", "One", "00001", "ASIA", "one")],
                                 "store_id string, store_name string, store_zip string, store_state string, "
                                 "store_city string")


def _doc(regular, **price):
    return {"productId": "A", "categories": ["Eggs"], "items": [{"price": {"regular": regular, **price}}]}


def test_promo_null_absent_and_empty_items(spark):
    raw = _raw_prices(spark, [_doc(2.5, promo=None), _doc(2.5), {"productId": "A", "items": []}])
    out = {r.load_id: r for r in staging.stg_prices(raw, _stores(spark)).collect()}
    assert out["L0"].is_on_sale is False and out["L0"].promo_price is None
    assert out["L1"].is_on_sale is False
    assert "L2" not in out  # no regular price -> dropped
    flagged = staging.stg_prices(raw, _stores(spark), json_null_is_present=True).collect()
    assert {r.load_id: r.is_on_sale for r in flagged}["L0"] is True


def test_negative_zero_and_rounding(spark):
    raw = _raw_prices(spark, [_doc(-1), _doc(0), _doc(3.995)])
    out = {r.load_id: r for r in staging.stg_prices(raw, _stores(spark)).collect()}
    assert "L0" not in out and out["L1"].regular_price == Decimal("0.00")
    assert out["L2"].regular_price == Decimal("4.00")  # HALF_UP
    zero = marts.sale_depth(F.lit(Decimal("1.00")), F.lit(Decimal("0.00")))
    assert spark.range(1).select(zero.alias("d")).first().d is None
    depth = marts.sale_depth(F.lit(Decimal("2.99")), F.lit(Decimal("4.00")))
    assert spark.range(1).select(depth.alias("d")).first().d == Decimal("0.2525")


def test_bad_regular_text_raises(spark):
    raw = _raw_prices(spark, [_doc("abc")])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        staging.stg_prices(raw, _stores(spark)).collect()


def test_unknown_store_kept_with_null_columns(spark):
    raw = _raw_prices(spark, [_doc(1.0)], store="S9")
    r = staging.stg_prices(raw, _stores(spark)).first()
    assert r.store_id == "S9" and r.store_name is None and r.store_state is None
    treated = causal.serving.flag_treated(spark.createDataFrame([(None,)], "store_state string"), ["ASIA"])
    assert treated.first().treatment == 0


def _raw_external(spark, source, payloads):
    rows = [(f"E{i}", dt.datetime(2025, 1, 1), source, json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "load_id string, loaded_at timestamp_ntz, source string, payload string")
    return df.select("load_id", "loaded_at", "source", F.parse_json("payload").alias("raw_payload"))


def test_usda_unparsable_values_dropped(spark):
    base = {"commodity_desc": "EGGS", "week_ending": "2025-01-05", "state_name": "IA"}
    vals = ["1,234", "(D)", "", "12345678.1", "12.5"]
    raw = _raw_external(spark, "USDA", [{**base, "Value": v} for v in vals])
    out = staging.stg_usda(raw).collect()
    assert [r.price_value for r in out] == [Decimal("12.5000")]


def test_bls_periods(spark):
    base = {"series_id": "X", "year": "2024", "value": "1.5"}
    raw = _raw_external(spark, "BLS", [{**base, "period": p} for p in ("M01", "M13", "A01", "S01")])
    out = staging.stg_bls(raw).collect()
    assert [(r.period, r.series_date) for r in out] == [("M01", D(2024, 1, 1))]


def _history_input(spark, prices, dates=None, loads=None, sale=None, item="A", store="S1"):
    n = len(prices)
    dates = dates or [D(2025, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    loads = loads or [f"L{i:04d}" for i in range(n)]
    sale = sale or [False] * n
    rows = [(loads[i], item, store, dates[i], Decimal(str(prices[i])),
             Decimal(str(prices[i])) if sale[i] else None, sale[i]) for i in range(n)]
    return spark.createDataFrame(rows, "load_id string, item_id string, store_id string, price_date date, "
                                       "regular_price decimal(10,2), promo_price decimal(10,2), is_on_sale boolean")


@pytest.mark.parametrize("n", [1, 7, 8, 31, 92])
def test_window_boundaries_against_brute_force(spark, n):
    prices = [round(1 + (i * 37 % 11) / 7, 2) for i in range(n)]
    rows = sorted(marts.price_history(_history_input(spark, prices)).collect(), key=lambda r: r.load_id)
    for i, r in enumerate(rows):
        d7 = None if i < 7 else Decimal(str(prices[i])) - Decimal(str(prices[i - 7]))
        d30 = None if i < 30 else Decimal(str(prices[i])) - Decimal(str(prices[i - 30]))
        prev = [Decimal(str(p)) for p in prices[max(0, i - 90):i]]
        avg = None if not prev else float(Decimal(str(prices[i]))) - float(sum(prev)) / len(prev)
        assert r.price_delta_7d == d7 and r.price_delta_30d == d30
        assert (r.price_vs_90d_avg is None) == (avg is None)
        if avg is not None:
            assert r.price_vs_90d_avg == pytest.approx(avg, abs=1e-12)


def test_two_loads_same_day_ordered_by_load_id(spark):
    df = _history_input(spark, [1.0, 2.0, 3.0], dates=[D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 2)],
                        loads=["L1", "L3", "L2"])
    tr = {r.load_id: r for r in marts.sale_transitions(df).collect()}
    assert len(tr) == 3
    flags = _history_input(spark, [1.0, 2.0, 3.0], dates=[D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 2)],
                           loads=["L1", "L3", "L2"], sale=[False, False, True])
    prev = {r.load_id: r.prev_on_sale for r in marts.sale_transitions(flags).collect()}
    assert prev == {"L1": None, "L2": False, "L3": True}  # L2 comes before L3 on the same day


def test_sale_start_first_row_and_open_end(spark):
    df = _history_input(spark, [4.0] * 10, sale=[True, True, False, False, True, True, False, False, True, True])
    eps = marts.promo_calendar_episodes(df).orderBy("episode").collect()
    assert [e.sale_start_date for e in eps] == [D(2025, 1, 1), D(2025, 1, 5), D(2025, 1, 9)]
    assert eps[0].sale_end_date == D(2025, 1, 3) and eps[-1].sale_end_date is None
    rng = marts.promo_calendar_range(df).collect()
    assert len(rng) == 2 + 1 + 1  # first start pairs with both later ends, second with one, last with none


def test_sale_toggle_two_starts(spark):
    df = _history_input(spark, [4.0] * 10, sale=[False, False, True, True, False, False, True, True, False, False])
    starts = marts.sale_starts(marts.sale_transitions(df)).orderBy("sale_start_date").collect()
    assert len(starts) == 2 and starts[0].sale_start_date == D(2025, 1, 3)


def test_labels_zero_price_and_exact_ten_percent(spark):
    prices = [0.0] + [4.0] * 6 + [0.0, 3.6] + [3.6] * 7
    df = features.build_labels(_history_input(spark, prices))
    lab = {r.load_id: r.label for r in df.collect()}
    assert lab["L0000"] == 0  # price 0 now -> 0
    assert lab["L0002"] == 1  # 4.00 -> 3.60 seven rows later: exactly 10 %
    assert len(lab) == len(prices) - 7


def test_upsert_duplicate_key_last_wins(spark):
    tgt = spark.createDataFrame([("S1", "old", "1", "IA", "a", dt.datetime(2020, 1, 1)),
                                 ("S2", "keep", "2", "MO", "b", dt.datetime(2020, 1, 1))],
                                "store_id string, store_name string, store_zip string, store_state string, "
                                "store_city string, _updated_at timestamp_ntz")
    src = spark.createDataFrame([("S1", "first", "1", "IA", "a", 1), ("S1", "last", "1", "IA", "a", 2),
                                 ("S3", "new", "3", "MN", "c", 1)],
                                "store_id string, store_name string, store_zip string, store_state string, "
                                "store_city string, seq int")
    out = {r.store_id: r for r in ingest.merge_store_lookup(tgt, src, "seq").collect()}
    assert out["S1"].store_name == "last" and out["S1"]._updated_at > dt.datetime(2020, 1, 1)
    assert out["S2"].store_name == "keep" and out["S2"]._updated_at == dt.datetime(2020, 1, 1)
    assert out["S3"].store_name == "new"


def test_backfill_date_fallback_and_normalisation(spark):
    items = spark.createDataFrame(
        [("P1", None, "2025-03-04T10:00:00Z", 2.0, True, None, "x", None, None),
         ("P2", "2025-03-05", None, 3.0, True, 0.0, "", ("named",), "dairy"),
         ("P3", "", "", 1.0, False, None, "z", None, None)],
        "product_id string, date string, created_at string, price double, price_is_discounted boolean, "
        "price_without_discount double, product_name string, product struct<product_name:string>, category string")
    dated = ingest.backfill_dates(items, "2025-01-01")
    assert {r.product_id: r.date_str for r in dated.collect()} == {"P1": "2025-03-04", "P2": "2025-03-05"}
    norm = {r.product_id: json.loads(r.payload) for r in ingest.normalize_crowd_prices(dated, "S0").collect()}
    assert norm["P1"]["items"][0]["price"] == {"regular": 2.0, "promo": 2.0}  # no undiscounted price -> regular = price
    assert norm["P2"]["description"] == "named" and norm["P2"]["categories"] == ["dairy"]
    assert norm["P1"]["categories"] == ["grocery"]
    zero = items.withColumn("price", F.lit(0.0)).withColumn("date_str", F.lit("2025-01-02")).withColumn(
        "loaded_at", F.lit(None).cast("timestamp_ntz"))
    p = json.loads(ingest.normalize_crowd_prices(zero, "S0").first().payload)
    assert "promo" not in p["items"][0]["price"]  # promo 0 omitted


def test_short_page_stops_pagination(spark):
    pages = spark.createDataFrame([("C", 1, [1, 2]), ("C", 2, [3]), ("C", 3, [4, 5]), ("D", 1, [6, 7])],
                                  "code string, page int, items array<int>")
    out = ingest.collapse_pages(pages, page_size=2, max_pages=10)
    assert sorted(r.item for r in out.collect()) == [1, 2, 3, 6, 7]
    capped = ingest.collapse_pages(pages, page_size=2, max_pages=1)
    assert sorted(r.item for r in capped.collect()) == [1, 2, 6, 7]


def test_metrics_single_class_and_no_positive_prediction(spark):
    one_class = spark.createDataFrame([(0.9, 1), (0.1, 1)], "score double, label int")
    m = classifier.binary_metrics(one_class).first()
    assert m.auc_roc == Decimal("0")
    none_pred = spark.createDataFrame([(0.1, 1), (0.2, 0)], "score double, label int")
    m = classifier.binary_metrics(none_pred).first()
    assert m.precision == Decimal("0") and m.recall == Decimal("0") and m.f1 == Decimal("0")


def test_auc_matches_pairwise_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(300)]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    expect = Decimal(str(round(wins / (len(pos) * len(neg)) + 1e-12, 4)))
    got = classifier.binary_metrics(spark.createDataFrame(rows, "score double, label int")).first().auc_roc
    assert got == expect


def _rdd_frame(spark, xs_ys):
    return spark.createDataFrame(xs_ys, "running_var int, is_on_sale boolean")


def test_rdd_month_end_single_right_row_gives_null_error(spark):
    data = [(-3, False), (-2, True), (-1, False), (0, True)]
    r = causal.local_linear_rdd(_rdd_frame(spark, data)).first()
    assert r.se is None and r.n_right == 1 and r.n_left == 3


def test_did_no_treated_store(spark):
    rows = [(f"L{i}", "A", f"S{i % 3}", "AFRICA", D(2024, 1, 20) + dt.timedelta(days=i % 20), Decimal("1.50") + i % 5,
             "Eggs") for i in range(60)]
    hist = spark.createDataFrame(rows, "load_id string, item_id string, store_id string, store_state string, "
                                       "price_date date, regular_price decimal(10,2), category string")
    r = causal.did(hist, "e", "2024-02-01", ["IA"], "Eggs", 4).first()
    assert r.att == 0.0 and r.pvalue is None and r.n_treated_stores == 0


def test_elasticity_excludes_zero_wholesale_and_needs_50(spark):
    rows = [(D(2025, 1, 1), "A", "S1", Decimal("2.00") + i, "Eggs", Decimal("0") if i == 0 else Decimal("1.5") + i,
             "EGGS") for i in range(55)]
    lagged = spark.createDataFrame(rows, "price_date date, item_id string, store_id string, regular_price decimal(10,2), "
                                         "category string, usda_price decimal(14,4), commodity string")
    r = causal.elasticity(lagged, "Eggs", 2).first()
    assert r.n_obs == 54
    assert causal.elasticity(lagged.limit(40), "Eggs", 2).count() == 0
