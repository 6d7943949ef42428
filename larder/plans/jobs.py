"""Batch jobs (L1-L4) and the evaluation report.

Each job is one Python function chaining DataFrame plans; intermediate marts
are written as tables (which also cuts lineage, so a lost executor recomputes
from the last written table rather than from the raw scan).  Output folders
live under the shared checkpoint folder unless a path is given.  With a path,
every write is an overwrite of it, a dynamic partition overwrite or an append of what it does not
hold yet, so a retried job converges to the same state.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.operators import causal, classifier, forecast, marts, staging
from larder.session import few, scratch_path, store
from larder.sources import fixtures as fx
from larder.sources import ingest, landing


LOG = logging.getLogger(__name__)


def _out(spark: SparkSession, out_dir: str | None, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}" if out_dir else scratch_path(spark, f"jobs/{uuid.uuid4().hex}/{name}")


def _table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _summary(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "step string, table_name string, rows long")


def job_daily(spark: SparkSession, sf_dir: str, out_dir: str | None = None, as_of: str = fx.AS_OF,
              lookback_days: int = 90) -> DataFrame:
    """L1: land -> staging -> price history + promo marts -> buy signals (one day overwritten)."""
    lookup_path, raw_path = _out(spark, out_dir, "store_lookup"), _out(spark, out_dir, "raw_prices")
    hist_path, promo_path = _out(spark, out_dir, "mart_price_history"), _out(spark, out_dir, "mart_promo_calendar")
    sig_path = _out(spark, out_dir, "mart_buy_signals")

    stores = fx.stores(spark, sf_dir).drop("n_nationkey")
    empty = spark.createDataFrame([], schemas.STORE_LOOKUP)  # first run: nothing landed yet
    lookup = ingest.merge_store_lookup(empty, stores.withColumn("_seq", F.lit(0)), "_seq")
    lookup.write.mode("overwrite").parquet(lookup_path)
    ingest.require_rows(spark.read.parquet(lookup_path), "no store to ask prices for")

    raw = landing.land_price_payloads(landing.price_documents(fx.fx_price(spark, sf_dir)))
    ingest.write_clustered(raw.withColumn("load_date", F.col("loaded_at").cast("date")), raw_path, "load_date",
                           ["store_id", "product_id"])
    stg = staging.stg_prices(spark.read.parquet(raw_path).drop("load_date"), spark.read.parquet(lookup_path))
    history = ingest.materialize(marts.price_history(stg), "mart_price_history", hist_path)
    promo = ingest.materialize(marts.promo_calendar(history), "mart_promo_calendar", promo_path)

    model, _ = classifier.train_classifier(history, lookback_days, as_of)
    _, models = forecast.fit_forecasts(history, lookback_days, as_of)
    n_sig = 0
    if model is not None:
        write_buy_signals(history, model, models, sig_path)
        n_sig = spark.read.parquet(sig_path).count()
    return _summary(spark, [
        ("land", "raw_prices", spark.read.parquet(raw_path).count()),
        ("mart", "mart_price_history", history.count()),
        ("mart", "mart_promo_calendar", promo.count()),
        ("ml", "mart_buy_signals", n_sig),
    ])


def job_weekly(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
               event_date: str = "1998-06-01", treated_states: list[str] | None = None,
               category: str = "Eggs") -> DataFrame:
    """L2: land three sources -> staging -> external signals mart -> DiD + elasticity."""
    raw_path, ext_path = _out(spark, out_dir, "raw_external"), _out(spark, out_dir, "mart_external_signals")
    raw = (
        landing.land_external_payloads(landing.usda_documents(fx.fx_usda(spark, sf_dir)), "USDA")
        .unionByName(landing.land_external_payloads(landing.bls_documents(fx.fx_bls(spark, sf_dir)), "BLS"))
        .unionByName(landing.land_external_payloads(landing.noaa_documents(fx.fx_noaa(spark, sf_dir)), "NOAA"))
    )
    raw.write.mode("overwrite").partitionBy("source").parquet(raw_path)
    landed = spark.read.parquet(raw_path)  # partition pruning on `source` in each staging model
    ext = marts.external_signals(staging.stg_usda(landed), staging.stg_noaa(landed), staging.stg_bls(landed))
    ext = ingest.materialize(ext, "mart_external_signals", ext_path)
    history = _table(marts.price_history(fx.fx_price(spark, sf_dir)), _out(spark, out_dir, "price_history"))
    att = causal.did(history, "weekly_event", event_date, treated_states or ["ASIA"], category, 4).first()
    el = causal.elasticity_report(causal.lagged_signal_join(history, ext, None, 2), None, 2).first()
    rows = [
        ("signals", "mart_external_signals", float(ext.count())),
        ("did", "att", att["att"]), ("did", "pvalue", att["pvalue"]), ("did", "n_obs", float(att["n_obs"])),
        ("iv", "elasticity", el["elasticity"] if el else None), ("iv", "n_obs", float(el["n_obs"]) if el else None),
    ]
    return spark.createDataFrame(rows, "step string, metric string, value double")


def evaluation_report(history: DataFrame, as_of: str = fx.AS_OF, lookback_days: int = 90,
                      trained: tuple | None = None) -> DataFrame:
    """Forecaster and classifier metrics as (model, metric, value, error) rows;
    one model failing does not stop the other.  `trained`: a classifier and its metrics, if there are any yet."""
    spark = history.sparkSession
    rows: list[tuple] = []

    def attempt(model: str, metrics) -> None:
        try:
            rows.extend((model, k, float(v), None) for k, v in metrics())
        except Exception as exc:  # noqa: BLE001 - one model's failure is reported and does not stop the other
            LOG.exception("evaluation of the %s failed", model)
            rows.append((model, "error", None, f"{type(exc).__name__}: {str(exc)[:500]}"))

    def forecaster():
        errors, _ = forecast.fit_forecasts(history, lookback_days, as_of)
        s = forecast.error_summary(errors).first()
        return [(k, s[k]) for k in ("mae_mean", "mape_mean", "n_models")]

    def tree_classifier():
        _, metrics = trained or classifier.train_classifier(history, lookback_days, as_of)
        m = metrics.first() if metrics is not None else None
        return [(k, m[k]) for k in ("precision", "recall", "f1", "auc_roc")] if m else []

    attempt("forecaster", forecaster)
    attempt("classifier", tree_classifier)
    return spark.createDataFrame(rows, "model string, metric string, value double, error string")


def job_retrain(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF, lookback_days: int = 90,
                out_dir: str | None = None) -> DataFrame:
    """L3: train both models, evaluate them, score the latest day and write its buy signals."""
    history = _table(marts.price_history(fx.fx_price(spark, sf_dir)), _out(spark, out_dir, "price_history"))
    trained = classifier.train_classifier(history, lookback_days, as_of)
    report = evaluation_report(history, as_of, lookback_days, trained)
    n = 0
    if trained[0] is not None:
        path = _out(spark, out_dir, "mart_buy_signals")
        _, models = forecast.fit_forecasts(history, lookback_days, as_of)
        write_buy_signals(history, trained[0], models, path)
        n = spark.read.parquet(path).count()
    return report.unionByName(spark.createDataFrame(
        [("inference", "mart_buy_signals", float(n), None)], report.schema))


def write_buy_signals(history: DataFrame, model, models: DataFrame, path: str) -> None:
    signals = classifier.buy_signals(history, model, forecast.forecast(models, 14, "series_end", bounds=True))
    signals = schemas.enforce_contract(signals, schemas.MART_BUY_SIGNALS, {"_loaded_at": F.localtimestamp()})
    ingest.overwrite_partitions(signals, path, "signal_date")


def job_backfill(spark: SparkSession, raw_prices: DataFrame, crowd_pages: DataFrame, days: int = 180,
                 as_of: str = fx.AS_OF, dry_run: bool = True, store_id: str = "S0",
                 out_path: str | None = None, page_size: int = 100, max_pages: int | None = None) -> DataFrame:
    """L4: tracked codes -> collapse pages -> dates -> skip existing -> normalize -> append what `out_path` does not hold.

    A row's load id is a hash of its code, date, place in the responses and payload, and its partition its
    date, so a second run over the same responses appends nothing.

    crowd_pages: (code, page, items array<struct<crowd record>>) as landed from the API.
    """
    import datetime as dt

    cutoff = (dt.date.fromisoformat(as_of) - dt.timedelta(days=days)).isoformat()
    codes = store(ingest.tracked_codes(raw_prices, sort=False).withColumnRenamed("product_id", "code"), "codes")
    pages = store(crowd_pages.join(few(codes), "code", "left_semi"), "crowd-pages")
    place = ("page", "pos")
    items = ingest.collapse_pages(pages, page_size, max_pages, stored=True).select(
        F.col("code").alias("product_id"), *[F.col(c).alias(f"_{c}") for c in place], "item.*")
    dated = ingest.backfill_dates(items, cutoff)
    fresh = ingest.backfill_anti_join(dated, few(store(ingest.existing_pairs(raw_prices, as_of), "pairs")))
    payloads = ingest.normalize_crowd_prices(fresh, store_id, keep=("_page", "_pos"))
    landed = landing.land_price_payloads(payloads.select(
        landing.load_id("product_id", "date_str", "_page", "_pos", "payload").alias("load_id"),
        "loaded_at", "store_id", "product_id", "payload"))
    landed = landed.withColumn("load_date", F.col("loaded_at").cast("date"))
    n = ingest.append_once(landed, out_path or _out(spark, None, "raw_prices_backfill"), "load_id", "load_date", dry_run)
    return spark.createDataFrame([(cutoff, dry_run, n)], "cutoff string, dry_run boolean, rows long")
