"""Serving queries over the marts.

Each function returns a DataFrame; the caller decides whether to collect.
Top-k results use `orderBy(...).limit(n)` over a total order (all output
columns after the ranking key) so ties cannot make the cut nondeterministic;
Catalyst plans this as TakeOrderedAndProject (per-partition top-n, then a
merge of n rows per partition), never a full sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.marts import latest_snapshot

MAX_LIMIT = 500


def _days(days: int, lo: int = 7, hi: int = 365) -> int:
    if not lo <= days <= hi:
        raise ValueError(f"days must be within [{lo}, {hi}]")
    return days


def _as_of(as_of: str | dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def trailing_days(df: DataFrame, date_col: str, days: int, as_of=None) -> DataFrame:
    """rows with date >= as_of - days (pushed to the scan as a date predicate)."""
    return df.filter(F.col(date_col) >= F.date_sub(_as_of(as_of), days))


def list_items(history: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (item, name, category) ordered by name; the first `limit` of them on request."""
    out = history.select("item_id", "item_name", "category").distinct().orderBy("item_name", "item_id", "category")
    return out if limit is None else out.limit(limit)


def list_stores(history: DataFrame) -> DataFrame:
    """V2."""
    return history.select("store_id").distinct().orderBy("store_id")


def list_categories(history: DataFrame) -> DataFrame:
    """V3: non-null categories."""
    return history.filter(F.col("category").isNotNull()).select("category").distinct().orderBy("category")


def series_history(history: DataFrame, item_id: str, store_id: str, days: int = 90, as_of=None,
                   falsy_to_null: bool = False) -> DataFrame:
    """V4: one series over the trailing window, ordered by date."""
    out = trailing_days(
        history.filter((F.col("item_id") == item_id) & (F.col("store_id") == store_id)),
        "price_date", _days(days), as_of,
    ).select(
        "price_date", "regular_price", "promo_price", "is_on_sale",
        "price_delta_7d", "price_delta_30d", "price_vs_90d_avg",
    )
    if falsy_to_null:
        out = out.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in
                               ("promo_price", "price_delta_7d", "price_delta_30d", "price_vs_90d_avg")})
    return out.orderBy("price_date")


def top_recommendations(buy_signals: DataFrame, recommendation: str | None = None, limit: int = 100) -> DataFrame:
    """Latest day's signals, optional type filter, best probability first."""
    if limit > MAX_LIMIT:
        raise ValueError(f"limit must be <= {MAX_LIMIT}")
    latest = latest_snapshot(buy_signals, "signal_date")
    if recommendation:
        latest = latest.filter(F.col("recommendation") == recommendation)
    cols = ["item_id", "store_id", "signal_date", "regular_price", "predicted_price_7d", "predicted_price_14d",
            "buy_now_probability", "recommendation", "model_version"]
    return latest.select(*cols).orderBy(
        F.col("buy_now_probability").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in cols if c != "buy_now_probability"]
    ).limit(limit)


def signals_window(ext: DataFrame, days: int = 90, signal_type: str | None = None, as_of=None) -> DataFrame:
    """V6: external signals over the trailing window, optional type filter (F8)."""
    out = trailing_days(ext, "signal_date", _days(days), as_of)
    if signal_type:
        out = out.filter(F.col("signal_type") == signal_type)
    return out.select("signal_date", "signal_type", "commodity", "value", "yoy_change_pct").orderBy("signal_date")


def coverage_summary(history: DataFrame, approximate: bool = False) -> DataFrame:
    """V7/A3/A4: distinct items, distinct stores, last date in one aggregation pass."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return history.agg(
        distinct("item_id").alias("total_items"),
        distinct("store_id").alias("total_stores"),
        F.max("price_date").alias("last_updated"),
    )


def recommendation_counts(buy_signals: DataFrame) -> DataFrame:
    """V7/A5: counts per recommendation on the latest day (NULL on empty input)."""
    latest = latest_snapshot(buy_signals, "signal_date")

    def count_of(rec: str) -> Column:
        return F.sum(F.when(F.col("recommendation") == rec, 1).otherwise(0)).alias(f"{rec.lower()}_count")

    return latest.agg(count_of("BUY_NOW"), count_of("WAIT"), count_of("NEUTRAL"))


def recommendation_value_counts(buy_signals: DataFrame) -> DataFrame:
    """Value counts of the latest day's recommendations."""
    return latest_snapshot(buy_signals, "signal_date").groupBy("recommendation").agg(F.count(F.lit(1)).alias("count"))


def sale_points(history: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """V8: sale-only points of one series."""
    return history.filter(
        (F.col("item_id") == item_id) & (F.col("store_id") == store_id) & F.col("is_on_sale")
    ).select("price_date", "load_id", "promo_price", "regular_price").orderBy("price_date", "load_id")


def item_store_picklist(history: DataFrame) -> DataFrame:
    """V9: the distinct items and the distinct stores, as one list of choices."""
    items = history.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("item_name").alias("name"))
    stores = history.select(F.lit("store").alias("kind"), F.col("store_id").alias("id"),
                            F.lit(None).cast("string").alias("name"))
    return items.distinct().unionByName(stores.distinct())


def commodity_series(ext: DataFrame, commodity: str, signal_type: str = "USDA") -> DataFrame:
    """The chosen commodity's series, date ordered."""
    return ext.filter((F.col("signal_type") == signal_type) & (F.col("commodity") == commodity)).select(
        "signal_date", "commodity", "value", "yoy_change_pct"
    ).orderBy("signal_date")


def commodity_choices(ext: DataFrame, signal_type: str = "USDA") -> DataFrame:
    return ext.filter(F.col("signal_type") == signal_type).select("commodity").distinct().orderBy("commodity")


def promo_heatmap(history: DataFrame) -> DataFrame:
    """Item x week sale-day counts (map-side partial aggregation before the shuffle)."""
    return history.groupBy(
        "item_id", F.date_trunc("week", F.col("price_date")).cast("date").alias("week_start")
    ).agg(
        F.count_distinct(F.when(F.col("is_on_sale"), F.col("price_date"))).alias("sale_days"),
        F.count_distinct("price_date").alias("observed_days"),
    )


def signals_wide(ext: DataFrame, commodities: list[str] | None = None, signal_type: str = "USDA",
                 tiebreak: str = "load_id") -> DataFrame:
    """Date x commodity pivot; of several rows per cell the last by `tiebreak` wins.

    Without `commodities` the columns are those the data has (the pivot then looks
    them up while the plan is built; its own limit on columns raises, it cuts nothing).
    """
    rows = ext.filter(F.col("signal_type") == signal_type).groupBy("signal_date")
    wide = rows.pivot("commodity") if commodities is None else rows.pivot("commodity", list(commodities))
    return wide.agg(F.max_by("value", tiebreak))


def latest_metrics(history: DataFrame) -> DataFrame:
    """T4: latest row of each series via max_by over (date, load_id): partial aggregation, no sort."""
    latest = F.max_by(
        F.struct("price_date", "regular_price", "promo_price", "is_on_sale", "price_delta_7d", "price_delta_30d",
                 "price_vs_90d_avg"),
        F.struct("price_date", "load_id"),
    ).alias("m")
    return history.groupBy("item_id", "store_id").agg(latest).select("item_id", "store_id", "m.*")


def series_keys(df: DataFrame) -> DataFrame:
    """Distinct (item, store) pairs."""
    return df.dropDuplicates(["item_id", "store_id"]).select("item_id", "store_id")


def filter_category(df: DataFrame, category: str) -> DataFrame:
    """case-insensitive containment; `%`/`_` in the argument stay wildcards (as in LIKE)."""
    return df.filter(F.col("category").ilike(f"%{category}%"))


def event_window(df: DataFrame, event_date: str, window_weeks: int = 4, date_col: str = "price_date") -> DataFrame:
    """inclusive date window event +- weeks."""
    ev = dt.date.fromisoformat(event_date)
    lo, hi = ev - dt.timedelta(weeks=window_weeks), ev + dt.timedelta(weeks=window_weeks)
    return df.filter(F.col(date_col).between(F.lit(lo), F.lit(hi)))


def flag_treated(df: DataFrame, treated_states: list[str], state_col: str = "store_state") -> DataFrame:
    """membership flag; a NULL state is control."""
    return df.withColumn("treatment", F.coalesce(F.col(state_col).isin(list(treated_states)), F.lit(False)).cast("int"))


def search_items(history: DataFrame, text: str) -> DataFrame:
    """items whose lower-cased id contains the lower-cased text."""
    return history.filter(F.lower("item_id").contains(text.lower())).select("item_id").distinct()
