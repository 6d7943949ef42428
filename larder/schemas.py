"""Schemas: raw landing envelopes and mart contracts (DDL types).

Raw JSON is never schema-inferred: envelopes are fixed and payloads are
VARIANT.  Mart contracts are applied with `enforce_contract` (X13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, StringType, StructField, StructType, TimestampNTZType,
    VariantType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


RAW_PRICES = _s(
    ("load_id", StringType(), False), ("loaded_at", TimestampNTZType(), False), ("store_id", StringType(), True),
    ("product_id", StringType(), True), ("raw_payload", VariantType(), False),
)
RAW_EXTERNAL = _s(
    ("load_id", StringType(), False), ("loaded_at", TimestampNTZType(), False), ("source", StringType(), False),
    ("raw_payload", VariantType(), False),
)
STORE_LOOKUP = _s(
    ("store_id", StringType(), False), ("store_name", StringType(), True), ("store_zip", StringType(), True),
    ("store_state", StringType(), True), ("store_city", StringType(), True),
    ("_updated_at", TimestampNTZType(), False),
)

MART_PRICE_HISTORY = _s(
    ("item_id", StringType(), False), ("item_name", StringType(), True), ("upc", StringType(), True),
    ("category", StringType(), True), ("store_id", StringType(), False), ("store_name", StringType(), True),
    ("store_zip", StringType(), True), ("store_state", StringType(), True), ("price_date", DateType(), False),
    ("regular_price", DecimalType(10, 2), True), ("promo_price", DecimalType(10, 2), True),
    ("is_on_sale", BooleanType(), True), ("price_delta_7d", DecimalType(10, 4), True),
    ("price_delta_30d", DecimalType(10, 4), True), ("price_vs_90d_avg", DecimalType(10, 4), True),
    ("_loaded_at", TimestampNTZType(), True),
)
MART_PROMO_CALENDAR = _s(
    ("item_id", StringType(), False), ("store_id", StringType(), False), ("sale_start_date", DateType(), True),
    ("sale_end_date", DateType(), True), ("sale_depth_pct", DecimalType(6, 4), True),
    ("days_since_last_sale", IntegerType(), True), ("avg_days_between_sales", DecimalType(8, 2), True),
    ("predicted_next_sale_date", DateType(), True), ("_loaded_at", TimestampNTZType(), True),
)
MART_EXTERNAL_SIGNALS = _s(
    ("signal_date", DateType(), False), ("signal_type", StringType(), False), ("commodity", StringType(), True),
    ("value", DecimalType(14, 4), True), ("yoy_change_pct", DecimalType(10, 4), True),
    ("weeks_to_retail_impact", IntegerType(), True), ("_loaded_at", TimestampNTZType(), True),
)
MART_BUY_SIGNALS = _s(
    ("item_id", StringType(), False), ("store_id", StringType(), False), ("signal_date", DateType(), False),
    ("regular_price", DecimalType(10, 2), True), ("predicted_price_7d", DecimalType(10, 2), True),
    ("predicted_price_14d", DecimalType(10, 2), True), ("buy_now_probability", DecimalType(6, 4), True),
    ("recommendation", StringType(), True), ("model_version", StringType(), True),
    ("confidence_interval_lower", DecimalType(10, 2), True), ("confidence_interval_upper", DecimalType(10, 2), True),
    ("_loaded_at", TimestampNTZType(), True),
)

CONTRACTS = {
    "mart_price_history": MART_PRICE_HISTORY,
    "mart_promo_calendar": MART_PROMO_CALENDAR,
    "mart_external_signals": MART_EXTERNAL_SIGNALS,
    "mart_buy_signals": MART_BUY_SIGNALS,
}


def enforce_contract(df: DataFrame, contract: StructType, defaults: dict | None = None) -> DataFrame:
    """Project onto the contract: cast each field, fill missing ones with a default or typed NULL.

    NOT NULL constraints are checked separately by `quality.not_null_report`.
    """
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for f in contract.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
