"""API-shaped documents derived from the driver tables.

The reference pulls these from HTTP APIs; here they are built from the
driver's tables so every ingest query's work grows with the data.  Arrays
inside a document are bounded by construction (<= 12 monthly observations
per series-year, <= `page_size` items per page, one location or product per
document).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.sources import fixtures as fx
from larder.session import few, store
from larder.sources.tables import read_table


def series_documents(bls: DataFrame) -> DataFrame:
    """One monthly-series document per (series, year): {"seriesID", "data": [<= 12 observations]}."""
    obs = F.struct(F.col("year").cast("string").alias("year"), "period", F.col("period_name").alias("periodName"),
                   F.col("value").cast("string").alias("value"),
                   F.array().cast("array<struct<code:string,text:string>>").alias("footnotes"))
    grouped = bls.groupBy("series_id", "year").agg(F.array_sort(F.collect_list(obs)).alias("data"))
    return grouped.select(F.to_json(F.struct(F.col("series_id").alias("seriesID"), "data")).alias("doc"))


def crowd_items(prices: DataFrame) -> DataFrame:
    """Crowd-sourced price records (one per price row); on-sale rows carry only `created_at`."""
    sale = F.col("is_on_sale")
    return prices.select(
        F.col("item_id").alias("product_id"), "upc", "load_id",
        F.when(sale, F.lit("")).otherwise(F.col("price_date").cast("string")).alias("date"),
        F.concat(F.col("price_date").cast("string"), F.lit("T10:00:00Z")).alias("created_at"),
        F.coalesce("promo_price", "regular_price").cast("double").alias("price"),
        sale.alias("price_is_discounted"),
        F.when(sale, F.col("regular_price")).cast("double").alias("price_without_discount"),
        F.col("item_name").alias("product_name"),
        F.struct(F.col("item_name").alias("product_name")).alias("product"),
        F.lower("category").alias("category"),
    )


def crowd_pages(items: DataFrame, code_col: str, page_size: int) -> DataFrame:
    """Paged API responses per product code: page k holds items (k-1)*size+1 .. k*size by load_id.

    No task holds all items of a code: they are dealt by ranges of (code, load_id), sorted and written once; an item's number
    is its place in its range plus the items of its code in the ranges before, from the table of ranges and codes.
    """
    placed = items.repartitionByRange(code_col, "load_id").sortWithinPartitions(code_col, "load_id").withColumn(
        "_id", F.monotonically_increasing_id())
    rows = store(placed, "crowd-items")
    part = F.shiftright("_id", 33)  # the documented layout of these ids: the partition above 33 bits of place
    before = Window.partitionBy("_code").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a range holds whole codes but for its first and last, so there are at most ranges + codes rows
    ranges = rows.groupBy(F.col(code_col).alias("_code"), part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    own = F.col(code_col).eqNullSafe(F.col("_code")) & (part == F.col("_part"))
    numbered = rows.join(few(ranges.drop("_n")), own).withColumn("_rn", F.col("_before") + F.col("_id") - F.col("_first"))
    item = F.struct(*[c for c in items.columns if c != code_col])
    return numbered.groupBy(F.col(code_col).alias("code"), (F.floor(F.col("_rn") / page_size) + 1).alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))


def location_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location-search responses: one per supplier, requested by the zip of its nation."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    st = fx.stores(spark, sf_dir)
    j = s.join(F.broadcast(st), F.col("s_nationkey") == F.col("n_nationkey"))
    loc = F.struct(
        F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("locationId"),
        F.col("s_name").alias("name"),
        F.struct(F.col("s_name").alias("addressLine1"), F.col("store_city").alias("city"),
                 F.col("store_state").alias("state"), F.col("store_zip").alias("zipCode")).alias("address"),
    )
    return j.select(F.col("store_zip").alias("zip"), F.col("s_suppkey").alias("doc_order"),
                    F.to_json(F.struct(F.array(loc).alias("data"))).alias("doc"))


def product_search_documents(prices: DataFrame) -> DataFrame:
    """Product-search responses per (location, term): {"data": [product]} (one product per document)."""
    product = F.struct(
        F.col("item_id").alias("productId"), F.col("item_name").alias("description"), "upc",
        F.array("category").alias("categories"),
        F.array(F.struct(F.struct(F.col("regular_price").alias("regular"), F.col("promo_price").alias("promo"))
                         .alias("price"), F.col("item_size").alias("size"), F.col("sold_by").alias("soldBy")))
        .alias("items"),
    )
    return prices.select(F.col("store_id").alias("location_id"), F.lower("category").alias("term"), "load_id",
                         F.to_json(F.struct(F.array(product).alias("data"))).alias("body"))


def store_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert source: store rows reported per supplier (duplicate keys) and new stores per customer nation."""
    st = fx.stores(spark, sf_dir)
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey").join(
        F.broadcast(st), F.col("s_nationkey") == F.col("n_nationkey"))
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(
        F.broadcast(st), F.col("c_nationkey") == F.col("n_nationkey"))
    from_suppliers = s.select(
        "store_id", F.col("s_name").alias("store_name"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("store_zip"),
        "store_state", F.lower("s_name").alias("store_city"), F.col("s_suppkey").alias("seq"))
    from_customers = c.select(
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("store_id"),
        F.col("c_name").alias("store_name"), F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("store_zip"),
        "store_state", F.lower("c_mktsegment").alias("store_city"), F.col("c_custkey").alias("seq"))
    return from_suppliers.unionByName(from_customers)
