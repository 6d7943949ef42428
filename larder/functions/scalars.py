"""Scalar function coverage: dates, strings, JSON, math (all JVM-side built-ins).

These are the column expressions the reference's SQL and pandas glue use,
written once as reusable helpers; each helper returns a projection.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_to_month_end(d: Column) -> Column:
    """day - days_in_month (always <= 0; 0 on the last day of the month)."""
    return F.dayofmonth(d) - F.dayofmonth(F.last_day(d))


def day_of_year_centered(d: Column, center: int = 182) -> Column:
    return F.dayofyear(d) - F.lit(center)


def ln_or_null(x: Column) -> Column:
    """Natural log with 0 -> NULL (instead of -inf)."""
    return F.ln(F.nullif(x, F.lit(0)).cast("double"))


def date_scalars(df: DataFrame, col: str, as_of: str) -> DataFrame:
    d = F.col(col)
    return df.select(
        "load_id", d.alias(col),
        F.weekday(d).alias("day_of_week"),
        (F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1).alias("week_of_month"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        day_of_year_centered(d).alias("day_of_year_centered"),
        days_to_month_end(d).alias("days_to_month_end"),
        F.date_sub(d, 14).alias("two_weeks_before"),
        F.add_months(d, -24).alias("two_years_before"),
        F.date_format(d, "yyyy-MM-dd").alias("date_text"),
        F.datediff(d, F.lit(as_of).cast("date")).alias("days_from_as_of"),
        F.date_trunc("week", d).cast("date").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
    )


def string_scalars(df: DataFrame) -> DataFrame:
    return df.select(
        "load_id",
        F.lower("item_id").alias("item_lower"),
        F.upper("category").alias("category_upper"),
        F.lpad(F.replace(F.col("item_id"), F.lit("Brand#"), F.lit("")), 3, "0").alias("brand_no"),
        F.substring("load_id", 1, 10).alias("load_prefix"),
        F.concat(F.col("item_id"), F.lit("|"), F.col("store_id")).alias("series_key"),
        F.lower("category").like("%il%").alias("has_il"),
        F.length("item_name").alias("name_length"),
        F.split_part(F.col("load_id"), F.lit("-"), F.lit(1)).alias("order_part"),
    )


def json_scalars(events: DataFrame) -> DataFrame:
    """events.props is JSON text {"k": n}: read through VARIANT and through a JSON path."""
    v = F.try_parse_json(F.col("props"))
    return events.select(
        "event_id",
        F.variant_get(v, "$.k", "int").alias("k"),
        F.get_json_object("props", "$.missing").cast("int").alias("missing"),
    )


def math_scalars(df: DataFrame) -> DataFrame:
    return df.select(
        "load_id",
        F.round(ln_or_null(F.col("regular_price")), 10).alias("log_price"),
        F.abs(F.col("regular_price") - F.coalesce("promo_price", "regular_price")).alias("abs_discount"),
        F.coalesce(F.col("promo_price"), F.lit(Decimal("0.00")).cast("decimal(10,2)")).alias("promo_or_zero"),
        F.col("is_on_sale").cast("int").alias("sale_int"),
        F.round(F.col("regular_price") * F.lit(Decimal("0.9")), 2).alias("ninety_pct"),
        F.col("l_quantity").cast("long").alias("qty"),
    )
