"""Structured Streaming landing of price payload files (optional extra to the batch X4).

New JSON-lines files in a folder are picked up incrementally.  Each micro-batch
is de-duplicated by `load_id`, anti-joined with what the raw table already
holds in the batch's own partitions, parsed to VARIANT and appended.  Nothing
depends on event time: late and old documents land like any other, and how
files fall into batches does not matter.  A batch that is run again after a
failure finds its rows in the table and appends only the missing ones.
`Trigger.AvailableNow` processes everything present and stops, so the same
code serves scheduled batch-style runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.ingest import repeated_keys
from larder.sources.landing import land_price_payloads, load_id

DOC_SCHEMA = "load_id string, loaded_at timestamp_ntz, store_id string, product_id string, payload string"
TABLE_SCHEMA = "load_id string, loaded_at timestamp_ntz, store_id string, product_id string, raw_payload variant, load_part date"


def price_doc_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(DOC_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(src_dir))


def land_batch(docs: DataFrame, table_path: str, granularity: str = "day") -> None:
    """Append the documents of one batch that the table does not hold yet.

    The partition column is the load day (or month for multi-year replays); a
    repeated load_id has the same load time and so the same partition, which
    keeps the look-up to the batch's partitions.  A document without a load_id is
    keyed by a hash of its content; one without a load time has the partition of those without.
    """
    day = F.col("loaded_at").cast("date")
    part = day if granularity == "day" else F.trunc(day, "month").cast("date")
    own = load_id("loaded_at", "store_id", "product_id", "payload")
    batch = docs.withColumn("load_id", F.coalesce("load_id", own)).withColumn("load_part", part)
    landed = docs.sparkSession.read.schema(TABLE_SCHEMA).parquet(table_path).select(
        "load_part", F.col("load_id").alias("_landed"))
    parts = batch.select(F.col("load_part").alias("_part")).distinct()
    landed = landed.join(parts, F.col("load_part").eqNullSafe(F.col("_part")), "left_semi").select("_landed")
    # documents are long: they are shuffled by id only if there is an id to drop
    if repeated_keys(batch, "load_id")[0]:
        batch = batch.dropDuplicates(["load_id"])
    fresh = batch if landed.isEmpty() else batch.join(landed, F.col("load_id") == F.col("_landed"), "left_anti")
    rows = land_price_payloads(fresh).withColumn("load_part", part)
    # ranges, not one task per partition value
    (rows.repartitionByRange("load_part", "store_id", "product_id").write.mode("append")
     .partitionBy("load_part").parquet(table_path))


def run_available_now(spark: SparkSession, src_dir: str, table_path: str, checkpoint: str,
                      granularity: str = "day", max_files_per_trigger: int = 1000) -> None:
    spark.createDataFrame([], TABLE_SCHEMA).write.mode("append").partitionBy("load_part").parquet(table_path)
    query = (price_doc_stream(spark, src_dir, max_files_per_trigger).writeStream
             .foreachBatch(lambda docs, _: land_batch(docs, table_path, granularity))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
