"""Staging models: typed views over the raw VARIANT landing tables.

Paths are case sensitive (`$.Value` has a capital V).  Strict casts use
`variant_get` (a bad value raises INVALID_VARIANT_CAST, like `::NUMBER`);
lenient ones use `try_cast` on the extracted text (like TRY_TO_NUMBER).
VARIANT values are never grouped or compared: every field is extracted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vget(path: str, dtype: str, col: str = "raw_payload") -> Column:
    return F.variant_get(F.col(col), path, dtype)


def scan_external(raw_ext: DataFrame, source: str) -> DataFrame:
    """Rows of one source; with a `partitionBy("source")` layout this prunes partitions."""
    return raw_ext.filter(F.col("source") == F.lit(source)).select("load_id", "loaded_at", "raw_payload")


def join_store_lookup(prices: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join to the store dimension (one row per store; broadcast by the planner)."""
    lookup = stores.select("store_id", "store_name", "store_zip", "store_state", "store_city")
    return prices.join(lookup, "store_id", "left")


PRICE_PAYLOAD_TYPE = (
    "struct<productId:string, description:string, upc:string, categories:array<string>, "
    "items:array<struct<price:struct<regular:decimal(10,2), promo:decimal(10,2)>, size:string, soldBy:string>>>"
)


def stg_prices(raw: DataFrame, stores: DataFrame, json_null_is_present: bool = False) -> DataFrame:
    """One typed row per product x store x load; drops missing item/price and negative prices.

    The payload is decoded once per row into a typed struct (one `variant_get`
    traversal instead of one per field); a value that cannot be cast (e.g. a
    price "abc") raises INVALID_VARIANT_CAST, as the strict `::NUMBER` does.
    Missing paths and empty arrays give NULL.
    """
    doc = vget("$", PRICE_PAYLOAD_TYPE)
    base = raw.filter(F.col("raw_payload").isNotNull()).select(
        "load_id", "loaded_at", "store_id", "raw_payload", doc.alias("d"))
    item0 = F.get(F.col("d.items"), 0)
    promo = item0["price"]["promo"]
    if json_null_is_present:
        on_sale = vget("$.items[0].price.promo", "variant").isNotNull()
    else:
        on_sale = promo.isNotNull()
    parsed = base.select(
        "load_id",
        F.col("loaded_at").cast("date").alias("price_date"),
        "store_id",
        F.col("d.productId").alias("item_id"),
        F.col("d.description").alias("item_name"),
        F.col("d.upc").alias("upc"),
        F.get(F.col("d.categories"), 0).alias("category"),
        item0["price"]["regular"].alias("regular_price"),
        promo.alias("promo_price"),
        F.when(on_sale, F.lit(True)).otherwise(F.lit(False)).alias("is_on_sale"),
        item0["size"].alias("item_size"),
        item0["soldBy"].alias("sold_by"),
    )
    joined = join_store_lookup(parsed, stores)
    return joined.filter(
        F.col("item_id").isNotNull() & F.col("regular_price").isNotNull() & (F.col("regular_price") >= 0)
    ).select(
        "load_id", "price_date", "store_id", "store_name", "store_zip", "store_state",
        "item_id", "item_name", "upc", "category", "regular_price", "promo_price",
        "is_on_sale", "item_size", "sold_by",
    )


def stg_usda(raw_ext: DataFrame) -> DataFrame:
    """Weekly commodity values; unparsable `Value` ("1,234", "(D)") drops the row."""
    parsed = scan_external(raw_ext, "USDA").select(
        "load_id",
        "loaded_at",
        vget("$.commodity_desc", "string").alias("commodity"),
        vget("$.statisticcat_desc", "string").alias("statistic_category"),
        vget("$.unit_desc", "string").alias("unit"),
        vget("$.year", "int").alias("year"),
        vget("$.week_ending", "string").cast("date").alias("week_ending_date"),
        vget("$.Value", "string").try_cast("decimal(10,4)").alias("price_value"),
        vget("$.state_name", "string").alias("state_name"),
        vget("$.agg_level_desc", "string").alias("agg_level"),
    )
    return parsed.filter(F.col("price_value").isNotNull() & F.col("week_ending_date").isNotNull())


def monthly_date(year: Column, period: Column) -> Column:
    """First of month from year + 'Mnn'; M13 and other invalid months give NULL."""
    text = F.concat(year, F.lit("-"), F.lpad(F.replace(period, F.lit("M"), F.lit("")), 2, "0"), F.lit("-01"))
    return F.try_to_date(text, "yyyy-MM-dd")


def stg_bls(raw_ext: DataFrame) -> DataFrame:
    """P3 + F2: monthly periods only (LIKE 'M%'), lenient value, date from year + period."""
    period = vget("$.period", "string")
    parsed = (
        scan_external(raw_ext, "BLS")
        .filter(F.col("raw_payload").isNotNull() & period.like("M%"))
        .select(
            "load_id",
            "loaded_at",
            vget("$.series_id", "string").alias("series_id"),
            vget("$.year", "int").alias("year"),
            period.alias("period"),
            vget("$.period_name", "string").alias("period_name"),
            vget("$.value", "string").try_cast("decimal(10,4)").alias("value"),
            monthly_date(vget("$.year", "string"), period).alias("series_date"),
        )
    )
    return parsed.filter(F.col("value").isNotNull() & F.col("series_date").isNotNull())


def parse_noaa(raw_ext: DataFrame) -> DataFrame:
    """Long-form weather observations from the raw payloads."""
    return scan_external(raw_ext, "NOAA").filter(F.col("raw_payload").isNotNull()).select(
        "load_id",
        "loaded_at",
        vget("$.date", "string").cast("date").alias("observation_date"),
        vget("$.station", "string").alias("station_id"),
        vget("$.datatype", "string").alias("data_type"),
        vget("$.value", "string").try_cast("decimal(10,2)").alias("observation_value"),
        vget("$.attributes", "string").alias("attributes"),
    )


def pivot_weather(long_obs: DataFrame, frost_max: float = 0, heat_min: float = 380) -> DataFrame:
    """A1/A2 + P4: station x date pivot by conditional MAX, distinct loads, frost/heat flags.

    Conditional aggregation (not `.pivot`) keeps the output schema fixed and
    lets the partial aggregate run map-side before the shuffle on
    (observation_date, station_id); other data types (AWND) are ignored.
    """
    def pick(kind: str) -> Column:
        return F.max(F.when(F.col("data_type") == F.lit(kind), F.col("observation_value")))

    wide = long_obs.groupBy("observation_date", "station_id").agg(
        pick("TMAX").alias("tmax_tenths_c"),
        pick("TMIN").alias("tmin_tenths_c"),
        pick("PRCP").alias("prcp_tenths_mm"),
        pick("SNOW").alias("snow_mm"),
        F.count_distinct("load_id").alias("source_loads"),
    )
    return wide.withColumns(
        {
            "is_frost_event": F.coalesce(
                F.col("tmin_tenths_c").isNotNull() & (F.col("tmin_tenths_c") <= F.lit(frost_max)), F.lit(False)
            ),
            "is_heat_event": F.coalesce(
                F.col("tmax_tenths_c").isNotNull() & (F.col("tmax_tenths_c") >= F.lit(heat_min)), F.lit(False)
            ),
        }
    )


def stg_noaa(raw_ext: DataFrame, frost_max: float = 0, heat_min: float = 380) -> DataFrame:
    """Staging weather = parse + pivot + flags (thresholds in tenths of a degree)."""
    return pivot_weather(parse_noaa(raw_ext), frost_max, heat_min)
