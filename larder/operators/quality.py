"""Data-quality checks (Q1-Q3): violation queries and not-null counts.

A violation query returns the offending rows (empty = pass).  Not-null checks
count NULLs for all listed columns of a table in ONE aggregation pass and
unpivot the counts to (table_name, column_name, failures).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The not-null tests declared for staging and mart models.
NOT_NULL_TESTS = {
    "stg_kroger_prices": ["item_id", "price_date", "regular_price"],
    "stg_usda_commodities": ["commodity", "week_ending_date"],
    "stg_noaa_weather": ["observation_date", "station_id"],
    "stg_bls_series": ["series_id", "series_date"],
    "mart_price_history": ["item_id", "store_id", "price_date", "regular_price"],
    "mart_promo_calendar": ["item_id", "store_id"],
    "mart_buy_signals": ["item_id", "signal_date"],
}


def negative_prices(history: DataFrame) -> DataFrame:
    """Q1: rows with a negative regular or promo price."""
    return history.filter((F.col("regular_price") < 0) | (F.col("promo_price") < 0)).select(
        "item_id", "store_id", "price_date", "regular_price"
    )


def not_null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q2 for one table: one pass of count_if(col IS NULL), unpivoted."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.col("failures").cast("long").alias("failures")
    )


def not_null_report(tables: dict[str, DataFrame], tests: dict[str, list[str]] = NOT_NULL_TESTS) -> DataFrame:
    out = None
    for name, cols in tests.items():
        if name not in tables:
            continue
        part = not_null_counts(tables[name], name, cols)
        out = part if out is None else out.unionByName(part)
    return out


def check_source_schema(df: DataFrame, expected: StructType) -> list[str]:
    """Q3: names of expected fields missing from a source (empty list = declared source exists)."""
    have = {f.name for f in df.schema.fields}
    return [f.name for f in expected.fields if f.name not in have]
