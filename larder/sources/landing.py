"""Raw payload documents and landing.

Payload documents are JSON text built with `to_json(struct(...))` from the
typed fixtures (null fields are omitted, so an absent `promo` arises
naturally); landing parses them into a VARIANT column with `parse_json`.
Everything is a distributed projection; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_ENVELOPE = ("load_id", "loaded_at", "store_id", "product_id", "raw_payload")
EXTERNAL_ENVELOPE = ("load_id", "loaded_at", "source", "raw_payload")


def price_documents(prices: DataFrame) -> DataFrame:
    """Price API documents (one per observation) as JSON text, tagged with location/term."""
    doc = F.struct(
        F.col("item_id").alias("productId"),
        F.col("item_name").alias("description"),
        F.col("upc"),
        F.array(F.col("category")).alias("categories"),
        F.array(
            F.struct(
                F.struct(F.col("regular_price").alias("regular"), F.col("promo_price").alias("promo")).alias("price"),
                F.col("item_size").alias("size"),
                F.col("sold_by").alias("soldBy"),
            )
        ).alias("items"),
        F.col("store_id").alias("_location_id"),
        F.lower(F.col("category")).alias("_search_term"),
    )
    return prices.select(
        "load_id",
        F.col("price_date").cast("timestamp_ntz").alias("loaded_at"),
        "store_id",
        F.col("item_id").alias("product_id"),
        F.to_json(doc).alias("payload"),
    )


def land_price_payloads(docs: DataFrame) -> DataFrame:
    """JSON text -> VARIANT landing rows (PARSE_JSON); malformed text raises."""
    return docs.select(
        "load_id", "loaded_at", "store_id", "product_id", F.parse_json(F.col("payload")).alias("raw_payload")
    )


def usda_documents(usda: DataFrame) -> DataFrame:
    doc = F.struct(
        F.col("commodity").alias("commodity_desc"),
        F.col("statistic_category").alias("statisticcat_desc"),
        F.col("unit").alias("unit_desc"),
        F.col("year"),
        F.col("week_ending_date").cast("string").alias("week_ending"),
        F.col("price_value").cast("string").alias("Value"),
        F.col("state_name"),
        F.col("agg_level").alias("agg_level_desc"),
    )
    return usda.select("load_id", F.col("week_ending_date").cast("timestamp_ntz").alias("loaded_at"),
                       F.to_json(doc).alias("payload"))


def bls_documents(bls: DataFrame) -> DataFrame:
    doc = F.struct(
        "series_id",
        F.col("year").cast("string").alias("year"),
        "period",
        "period_name",
        F.col("value").cast("string").alias("value"),
    )
    return bls.select("load_id", F.col("series_date").cast("timestamp_ntz").alias("loaded_at"),
                      F.to_json(doc).alias("payload"))


def noaa_documents(noaa: DataFrame) -> DataFrame:
    doc = F.struct(
        F.concat(F.col("observation_date").cast("string"), F.lit("T00:00:00")).alias("date"),
        F.col("station_id").alias("station"),
        F.col("data_type").alias("datatype"),
        F.col("observation_value").alias("value"),
        F.col("attributes"),
    )
    return noaa.select("load_id", F.col("observation_date").cast("timestamp_ntz").alias("loaded_at"),
                       F.to_json(doc).alias("payload"))


def land_external_payloads(docs: DataFrame, source: str) -> DataFrame:
    """Tag with the source and parse; an empty input lands nothing (no special case needed)."""
    return docs.select(
        "load_id", "loaded_at", F.lit(source).alias("source"), F.parse_json(F.col("payload")).alias("raw_payload")
    )


def scan_raw_prices(raw: DataFrame) -> DataFrame:
    """Envelope columns plus the typed identity fields read from the payload."""
    return raw.select(
        "load_id", "loaded_at", "store_id", "product_id",
        F.variant_get("raw_payload", "$.productId", "string").alias("payload_product_id"),
        F.variant_get("raw_payload", "$._location_id", "string").alias("payload_location_id"),
    )


def load_id(*key_cols: str) -> Column:
    """A hash of the key columns; a NULL part is told apart from any value, and parts do not run together."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in key_cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def with_load_metadata(docs: DataFrame, key_cols: list[str], deterministic: bool = True) -> DataFrame:
    """Generated load id + load time.

    The default id is a hash of `key_cols`, which must identify a row (a natural
    key plus what tells repeated loads apart): a retried task then writes the
    same ids.  `deterministic=False` gives random UUIDs.
    """
    made = load_id(*key_cols) if deterministic else F.expr("uuid()")
    return docs.withColumn("load_id", made).withColumn("loaded_at", F.localtimestamp())
