"""Landing, tagging, ids, joins and forecasts where the registered queries' data has no odd cases."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from larder.operators import causal, classifier, forecast, marts, serving
from larder.sources import fixtures as fx
from larder.sources import ingest, landing
from larder.streaming import landing_stream

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_stream_lands_every_row_however_files_fall_into_batches(spark, tmp_path, files_per_batch):
    docs = landing.price_documents(fx.fx_price(spark, SF_SMALL))
    docs.repartition(4).write.json(f"{tmp_path}/in")
    docs.limit(50).write.json(f"{tmp_path}/again")  # delivered twice
    run = lambda src: landing_stream.run_available_now(
        spark, f"{tmp_path}/{src}", f"{tmp_path}/raw", f"{tmp_path}/ckpt-{src}", "month", files_per_batch)
    run("in")
    run("again")
    landed = spark.read.parquet(f"{tmp_path}/raw")
    assert landed.count() == docs.count() == landed.select("load_id").distinct().count()


def test_one_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit("2024-01-01").cast("date").alias("day"), F.col("id").cast("string").alias("item_id"),
                                      (F.col("id") % 7).cast("string").alias("store_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.overwrite_partitions(rows, f"{tmp_path}/t", "day")
        other = rows.limit(10).withColumn("day", F.lit("2024-01-02").cast("date"))
        ingest.overwrite_partitions(other, f"{tmp_path}/t", "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 20_010
    assert back.where("day = '2024-01-01'").select(F.input_file_name()).distinct().count() > 1
    assert ingest.append(other, f"{tmp_path}/a") == ingest.append(other, f"{tmp_path}/a", dry_run=True) == 10


def test_tags_replace_and_bad_documents_are_rejected(spark):
    body = json.dumps({"data": [{"productId": "p", "_location_id": "old", "n": 1.5}, {"x": [1, None]}]})
    docs = spark.createDataFrame([("L", "milk", body), ("L", "t1", '{"data": 5}'), ("L", "t2", "{"), ("L", "t3", None),
                                  ("L", "t4", '{"data": [1, 2]}'), ("L", "t5", '{"data": []}'), (None, None, body)],
                                 "location_id string, term string, body string")
    tagged, rejects = ingest.tag_payloads(docs)
    got = [(r.store_id, r.product_id, json.loads(r.j)) for r in
           tagged.select("store_id", "product_id", F.to_json("raw_payload").alias("j")).collect()]
    assert (("L", "p", {"productId": "p", "n": 1.5, "_location_id": "L", "_search_term": "milk"})) in got
    assert ("L", None, {"x": [1, None], "_location_id": "L", "_search_term": "milk"}) in got and len(got) == 4
    assert sorted(r.term for r in rejects.collect()) == ["t1", "t2", "t3", "t4"]


def test_load_ids_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a", "~", "b"), ("a", "", "b")],
                               "x string, y string, z string")
    ids = [r.load_id for r in landing.with_load_metadata(df, ["x", "y", "z"]).collect()]
    assert len(set(ids)) == 5
    assert landing.with_load_metadata(df, ["x"], deterministic=False).select("load_id").distinct().count() == 5


def test_lagged_join_keeps_wildcards(spark):
    day = dt.date(2024, 1, 15)
    prices = spark.createDataFrame([(day, "i", "s", 1.0, c) for c in ("e_gs", "eggs", "E%S", "milk", "", None, "a\\b")],
                                   "price_date date, item_id string, store_id string, regular_price double, category string")
    ext = spark.createDataFrame([(day - dt.timedelta(days=14), "USDA", "EGGS", 2.0), (day, "USDA", "EGGS", 3.0),
                                 (day - dt.timedelta(days=14), "USDA", "A\\B", 4.0)],
                                "signal_date date, signal_type string, commodity string, value double")
    got = sorted((r.category, r.commodity) for r in causal.lagged_signal_join(prices, ext).collect())
    assert got == sorted([("e_gs", "EGGS"), ("eggs", "EGGS"), ("E%S", "EGGS"), ("", "EGGS"), ("", "A\\B"), ("a\\b", "A\\B")])


def _models(spark):
    data = forecast.forecast_input(fx.fx_price(spark, SF_SMALL), 3650, "2001-11-04")
    return forecast.trend_weekday_models(forecast.fit_trend_weekday(data))


def test_step_14_is_day_14(spark):
    models = _models(spark).cache()
    by = {h: {(r.item_id, r.store_id): (r.yhat_7, r.yhat_14) for r in forecast.forecast(models, h).collect()} for h in (7, 14, 21)}
    assert by[14] == by[21] and all(v[1] is None for v in by[7].values()) and len(by[7]) == len(by[14]) > 0
    daily = forecast.forecast_daily(models, 3, "train_end")
    assert daily.columns == ["item_id", "store_id", "anchor", "step", "ds", "yhat", "yhat_lower", "yhat_upper"]
    assert daily.where("datediff(ds, anchor) <> step").count() == 0 and daily.count() == 3 * models.count()


def test_empty_inputs_of_both_models(spark):
    none = marts.price_history(fx.fx_price(spark, SF_SMALL).limit(0))
    assert classifier.train_classifier(none, 90, "2001-11-04") == (None, None)
    errors, models = forecast.fit_forecasts(none, 90, "2001-11-04")
    assert errors.count() == models.count() == forecast.forecast(models).count() == 0
    assert forecast.fourier_forecasts(forecast.forecast_input(none, 90, "2001-11-04")).count() == 0
    assert forecast.residual_stage(none, 90, "2001-11-04") == (None, None)
    assert tuple(forecast.error_summary(errors).first()) == (0.0, 0.0, 0)


def test_optional_filters_and_missing_stores(spark):
    ext = spark.createDataFrame([(dt.date(2024, 1, 1), "USDA", "EGGS", 2.0, "b"), (dt.date(2024, 1, 1), "USDA", "EGGS", 1.0, "c"),
                                 (dt.date(2024, 1, 1), "USDA", "RYE", 9.0, "a")],
                                "signal_date date, signal_type string, commodity string, value double, load_id string")
    wide = serving.signals_wide(ext)
    assert wide.columns == ["signal_date", "EGGS", "RYE"] and tuple(wide.first())[1:] == (1.0, 9.0)  # the last load wins
    assert serving.list_items(fx.fx_price(spark, SF_SMALL), limit=3).count() == 3
    with pytest.raises(RuntimeError, match="no store"):
        ingest.require_rows(ext.limit(0), "no store to ask prices for")


def test_tagging_parses_a_document_once(spark):
    from larder.sources import ingest

    docs = spark.createDataFrame([("S1", "eggs", '{"data": [{"productId": "a"}, null]}'), ("S1", "eggs", '{"data": []}'),
                                  ("S2", "milk", '{"data": [{"productId": "b"}, {"productId": "c"}]}'), ("S3", "x", None)],
                                 "location_id string, term string, body string")
    tagged, rejects = ingest.tag_payloads(docs)
    assert sorted(r["product_id"] for r in tagged.collect()) == ["b", "c"]
    assert sorted(r["location_id"] for r in rejects.collect()) == ["S1", "S3"]
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_crowd_pages_number_items_without_a_window_per_code(spark):
    from larder.sources import documents

    rows = [("a" if k % 9 else None, f"{k * 7919 % 1000:04d}") for k in range(900)] + [("b", "x")]
    pages = documents.crowd_pages(spark.createDataFrame(rows, "code string, load_id string").repartition(5), "code", 50)
    assert "row_number" not in pages._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["code"], r["page"]): [i["load_id"] for i in r["items"]] for r in pages.collect()}
    want = {}
    for code in ("a", "b", None):
        ids = sorted(i for c, i in rows if c == code)
        want |= {(code, k // 50 + 1): ids[k:k + 50] for k in range(0, len(ids), 50)}
    assert got == want


def test_distinct_documents_land_without_a_shuffle_for_ids(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from larder.sources import ingest
    from larder.streaming import landing_stream

    rows = spark.createDataFrame([("a",), ("b",), (None,)], "load_id string")
    assert ingest.repeated_keys(rows, "load_id") == (False, True)
    assert ingest.repeated_keys(rows.unionAll(rows.limit(0)).filter("load_id is not null"), "load_id") == (False, False)
    assert ingest.repeated_keys(rows.unionAll(rows), "load_id") == (True, True)
    assert ingest.repeated_keys(rows.limit(0), "load_id") == (False, False)
    docs = spark.createDataFrame([(k, "S1", "p", '{"a": 1}') for k in ("a", "b")], "load_id string, store_id string, product_id string, payload string")
    docs = docs.selectExpr("load_id", "timestamp_ntz'2024-01-01 00:00:00' AS loaded_at", "store_id", "product_id", "payload")
    path = f"{tmp_path}/t"
    spark.createDataFrame([], landing_stream.TABLE_SCHEMA).write.partitionBy("load_part").parquet(path)
    landing_stream.land_batch(docs.unionAll(docs), path)
    landing_stream.land_batch(docs, path)
    assert spark.read.parquet(path).count() == 2

    def fail(*_):
        raise AssertionError("whole documents were shuffled by id")

    monkeypatch.setattr(DataFrame, "dropDuplicates", fail)
    landing_stream.land_batch(docs.withColumn("load_id", docs["product_id"]).limit(1), path)
    assert spark.read.parquet(path).count() == 3
