"""Domain views over the driver's tables (see FIXTURES.md §2).

The driver tables hold no grocery data, so price observations, weekly
commodity values, monthly series and weather observations are derived from
lineitem/part/supplier/nation/region, orders and events.  Each view is a
lazy DataFrame; Catalyst prunes columns and pushes filters into the scans.

Only the 25-row nation and 5-row region tables are broadcast explicitly;
their size is fixed by the TPC-H specification.  Joins of lineitem with part
and supplier are left to the planner (size-checked broadcast below the
threshold, sort-merge above it, AQE at runtime).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.tables import read_table

# Fixed values (must equal the fixture definition): brand number mod 4 -> category.
CATEGORY_BY_BRAND_MOD = {0: "Eggs", 1: "Broilers", 2: "Cattle", 3: "Milk"}

# Events.event_type -> weather data type; "error" maps to AWND,
# which the staging pivot ignores.
WEATHER_TYPE_BY_EVENT = {
    "view": "TMAX",
    "click": "TMIN",
    "purchase": "PRCP",
    "signup": "SNOW",
    "error": "AWND",
}

SALE_DISCOUNT = 0.08
AS_OF = "2001-11-04"  # latest price_date in the fixtures; trailing windows end here


def _case_map(key: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension (one store per nation): store_id, name, zip, state, city."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("store_zip"),
        F.col("r_name").alias("store_state"),
        F.lower(F.col("n_name")).alias("store_city"),
        F.col("n_nationkey"),
    )


def fx_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations, one row per lineitem: item (brand) x store (nation) x date."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_discount", "l_quantity", "l_shipdate",
    )
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name", "p_size", "p_retailprice")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    st = stores(spark, sf_dir)

    joined = (
        li.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(st), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    regular = F.col("p_retailprice").cast("decimal(10,2)")
    on_sale = F.col("l_discount") >= F.lit(SALE_DISCOUNT)
    brand_no = F.substring_index(F.col("p_brand"), "#", -1).cast("int")
    return joined.select(
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
        ).alias("load_id"),
        F.col("l_shipdate").cast("date").alias("price_date"),
        F.col("store_id"),
        F.col("store_name"),
        F.col("store_zip"),
        F.col("store_state"),
        F.col("p_brand").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("upc"),
        _case_map(brand_no % 4, CATEGORY_BY_BRAND_MOD).alias("category"),
        regular.alias("regular_price"),
        F.when(
            on_sale,
            (regular * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast(
                "decimal(10,2)"
            ),
        ).alias("promo_price"),
        on_sale.alias("is_on_sale"),
        F.concat(F.col("p_size").cast("string"), F.lit(" oz")).alias("item_size"),
        F.lit("UNIT").alias("sold_by"),
        F.col("l_quantity"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
    )


def week_ending(date_col: Column) -> Column:
    """Sunday that ends the Monday-based week containing the date."""
    return F.date_add(F.date_trunc("week", date_col).cast("date"), 6)


def fx_usda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly commodity values per (commodity, state): typed staging shape."""
    p = fx_price(spark, sf_dir)
    agg = p.groupBy(
        F.upper("category").alias("commodity"),
        F.col("store_state").alias("state_name"),
        week_ending(F.col("price_date")).alias("week_ending_date"),
    ).agg(F.sum("l_quantity").cast("decimal(10,4)").alias("price_value"))
    return agg.select(
        F.concat_ws("-", F.lit("USDA"), "commodity", "state_name", F.col("week_ending_date").cast("string")).alias(
            "load_id"
        ),
        "commodity",
        F.lit("PRICE RECEIVED").alias("statistic_category"),
        F.lit("$ / UNIT").alias("unit"),
        F.year("week_ending_date").alias("year"),
        "week_ending_date",
        "price_value",
        "state_name",
        F.lit("STATE").alias("agg_level"),
    )


def fx_bls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly series: order counts per status and month."""
    o = read_table(spark, sf_dir, "orders", "o_orderstatus", "o_orderdate")
    agg = o.groupBy(
        F.concat(F.lit("SERIES_"), F.col("o_orderstatus")).alias("series_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("series_date"),
    ).agg(F.count(F.lit(1)).cast("decimal(10,4)").alias("value"))
    return agg.select(
        F.concat_ws("-", F.lit("BLS"), "series_id", F.col("series_date").cast("string")).alias("load_id"),
        "series_id",
        F.year("series_date").alias("year"),
        F.concat(F.lit("M"), F.lpad(F.month("series_date").cast("string"), 2, "0")).alias("period"),
        F.date_format("series_date", "MMMM").alias("period_name"),
        "value",
        "series_date",
    )


def fx_noaa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather observations in long form (one row per event)."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    data_type = _case_map(F.col("event_type"), WEATHER_TYPE_BY_EVENT)
    raw_value = F.col("value").cast("decimal(10,2)")
    value = (
        F.when(data_type == "TMIN", raw_value - F.lit(20))
        .when(data_type == "TMAX", raw_value * F.lit(4))
        .otherwise(raw_value)
        .cast("decimal(10,2)")
    )
    return e.select(
        F.col("event_id").cast("string").alias("load_id"),
        F.col("ts").cast("date").alias("observation_date"),
        F.concat(F.lit("ST"), (F.col("user_id") % 20).cast("string")).alias("station_id"),
        data_type.alias("data_type"),
        value.alias("observation_value"),
        F.lit(",,N,").alias("attributes"),
    )


def fx_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score per price row for metric/threshold checks; label = is_on_sale."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    score = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 1000).cast(
        "double"
    ) / F.lit(1000.0)
    return li.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        score.alias("score"),
        (F.col("l_discount") >= F.lit(SALE_DISCOUNT)).cast("int").alias("label"),
    )
