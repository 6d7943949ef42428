"""Ingest data work (X6, X8-X12, X14-X20), re-aimed from HTTP loops to Spark jobs.

The reference fetches API documents in Python loops; here the documents are
already landed (JSON text or nested columns) and every step is a
distributed projection, aggregation or join:

* flatten_series      explode nested observation arrays
* collapse_pages      first short page per code (aggregate) -> keep pages up to it -> explode
* normalize_crowd     crowd price record -> price payload (when/coalesce/round, to_json)
* backfill_dates      observation date from `date` or `created_at`, cutoff, 08:00 stamp
* anti join           skip (product, date) pairs already landed before `as_of`
* merge_store_lookup  MERGE as full outer join, source wins on match
* stores_from_locations  first location per zip (min_by: partial aggregation)
* tag_payloads        explode product documents, tag with (location, term); malformed -> rejects
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from larder.session import few

# ---------------------------------------------------------------------------
# X8 flatten nested series documents
# ---------------------------------------------------------------------------

SERIES_DOC_SCHEMA = (
    "seriesID string, data array<struct<year:string, period:string, periodName:string, value:string, "
    "footnotes:array<struct<code:string, text:string>>>>"
)


def flatten_series(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """One row per observation; series without data produce no rows."""
    parsed = docs.select(F.from_json(F.col(doc_col), SERIES_DOC_SCHEMA).alias("d"))
    return parsed.select(F.col("d.seriesID").alias("series_id"), F.explode("d.data").alias("o")).select(
        "series_id",
        F.col("o.year").alias("year"),
        F.col("o.period").alias("period"),
        F.col("o.periodName").alias("period_name"),
        F.col("o.value").alias("value"),
        F.to_json(F.col("o.footnotes")).alias("footnotes"),
    )


# ---------------------------------------------------------------------------
# X9 paginated results
# ---------------------------------------------------------------------------


def collapse_pages(pages: DataFrame, page_size: int = 100, max_pages: int | None = None, stored: bool = False) -> DataFrame:
    """Union of `items` over pages 1..stop per code, stop = first page shorter than page_size
    (pages after a short page are ignored).  `max_pages` is for callers that page through a network
    source and want to stop early; landed pages are all used.  `stored`: reading `pages` is cheap, so the codes may be
    counted, and pages are not shuffled to meet them where they are few."""
    sized = pages.withColumn("_short", F.size("items") < page_size)
    stop = sized.groupBy("code").agg(
        F.min(F.when(F.col("_short"), F.col("page"))).alias("_stop"))
    kept = sized.join(few(stop) if stored else stop, "code").filter(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop")))
    if max_pages is not None:
        kept = kept.filter(F.col("page") <= max_pages)
    return kept.select("code", "page", F.posexplode("items").alias("pos", "item"))


# ---------------------------------------------------------------------------
# X10 / X11 / X12 crowd price backfill
# ---------------------------------------------------------------------------


# The tag of backfilled payloads and the category of items without one.
BACKFILL_SOURCE, DEFAULT_CATEGORY = "open_prices_backfill", "grocery"


def backfill_dates(items: DataFrame, cutoff: str) -> DataFrame:
    """X11: date_str = `date` or the first 10 chars of `created_at`; keep non-empty >= cutoff (string compare)."""
    date_str = F.coalesce(F.nullif(F.col("date"), F.lit("")), F.substring(F.coalesce("created_at", F.lit("")), 1, 10))
    out = items.withColumn("date_str", date_str)
    return out.filter((F.col("date_str") != "") & (F.col("date_str") >= F.lit(cutoff))).withColumn(
        "loaded_at", F.to_timestamp_ntz(F.concat(F.col("date_str"), F.lit(" 08:00:00"))))


def existing_pairs(raw_prices: DataFrame, as_of: str) -> DataFrame:
    """(product_id, date) pairs already landed before `as_of`."""
    return raw_prices.filter(F.col("loaded_at").cast("date") < F.lit(as_of).cast("date")).select(
        "product_id", F.date_format(F.col("loaded_at").cast("date"), "yyyy-MM-dd").alias("date_str")).distinct()


def backfill_anti_join(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop candidates whose (product_id, date) already exists; duplicates inside one run survive."""
    return candidates.join(existing, ["product_id", "date_str"], "left_anti")


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def normalize_crowd_prices(items: DataFrame, store_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Crowd price record -> price payload JSON (regular/promo rules, round 2, defaults)."""
    discounted = F.coalesce(F.col("price_is_discounted"), F.lit(False))
    price = F.coalesce(F.col("price"), F.lit(0.0))
    regular = F.round(F.when(discounted & _truthy(F.col("price_without_discount")), F.col("price_without_discount"))
                      .otherwise(price), 2)
    promo_raw = F.when(discounted, price)
    promo = F.when(_truthy(promo_raw), F.round(promo_raw, 2))  # promo 0 is omitted
    description = F.coalesce(F.nullif(F.col("product_name"), F.lit("")),
                             F.nullif(F.col("product.product_name"), F.lit("")), F.lit(""))
    category = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit(DEFAULT_CATEGORY))
    doc = F.struct(
        F.col("product_id").alias("productId"),
        description.alias("description"),
        F.col("product_id").alias("upc"),
        F.array(category).alias("categories"),
        F.array(F.struct(F.struct(regular.alias("regular"), promo.alias("promo")).alias("price"),
                         F.lit("").alias("size"), F.lit("UNIT").alias("soldBy"))).alias("items"),
        F.lit(BACKFILL_SOURCE).alias("_source"),
        F.lit(store_id).alias("_location_id"),
    )
    return items.select(
        *keep, F.lit(store_id).alias("store_id"), "product_id", "date_str", "loaded_at",
        F.to_json(doc).alias("payload"),
    )


def tracked_codes(raw_prices: DataFrame, sort: bool = True) -> DataFrame:
    """Distinct non-null, non-empty product ids (sorted for listing; unsorted when joined)."""
    codes = raw_prices.filter(F.col("product_id").isNotNull() & (F.col("product_id") != "")).select(
        "product_id").distinct()
    return codes.orderBy("product_id") if sort else codes


# ---------------------------------------------------------------------------
# X6 / X19 store dimension
# ---------------------------------------------------------------------------

STORE_COLS = ("store_name", "store_zip", "store_state", "store_city")


def merge_store_lookup(target: DataFrame, source: DataFrame, tiebreak: str, now: Column | None = None) -> DataFrame:
    """MERGE INTO target USING source ON store_id.

    Matched: all attributes from the source, `_updated_at` refreshed.  Not
    matched: inserted.  Duplicate source keys: the last by `tiebreak` wins
    (max_by: partial aggregation, no sort of a hot key).
    """
    now = F.localtimestamp() if now is None else now
    latest = source.groupBy("store_id").agg(
        F.max_by(F.struct(*STORE_COLS), F.col(tiebreak)).alias("s")).select("store_id", "s.*")
    t, s = target.alias("t"), latest.alias("s")
    matched = F.col("s.store_id").isNotNull()
    return t.join(s, F.col("t.store_id") == F.col("s.store_id"), "full_outer").select(
        F.coalesce(F.col("s.store_id"), F.col("t.store_id")).alias("store_id"),
        *[F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in STORE_COLS],
        F.when(matched, now).otherwise(F.col("t._updated_at")).cast("timestamp_ntz").alias("_updated_at"),
    )


LOCATION_DOC_SCHEMA = (
    "data array<struct<locationId:string, name:string, "
    "address:struct<addressLine1:string, city:string, state:string, zipCode:string>>>"
)


def stores_from_locations(location_docs: DataFrame) -> DataFrame:
    """First location per requested zip -> store rows (zip requests without a location give none)."""
    locs = location_docs.select(
        "zip", "doc_order", F.posexplode(F.from_json("doc", LOCATION_DOC_SCHEMA).getField("data")).alias("pos", "loc"))
    first = locs.groupBy("zip").agg(F.min_by(F.col("loc"), F.struct("doc_order", "pos")).alias("loc"))
    return first.select(
        F.col("loc.locationId").alias("store_id"),
        F.coalesce(F.col("loc.name"), F.lit("")).alias("store_name"),
        F.coalesce(F.col("loc.address.zipCode"), F.lit("")).alias("store_zip"),
        F.coalesce(F.col("loc.address.state"), F.lit("")).alias("store_state"),
        F.coalesce(F.col("loc.address.city"), F.lit("")).alias("store_city"),
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when a required result is empty (one cheap `isEmpty` probe)."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


# ---------------------------------------------------------------------------
# X20 tag product documents
# ---------------------------------------------------------------------------


def tag_payloads(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Explode product-search documents and tag each product with (_location_id, _search_term).

    docs: (location_id, term, body) with body = {"data": [product, ...]} as JSON text.
    Returns (tagged payload rows, rejected documents).  A document is rejected,
    and does not fail the job, when it is no JSON or its `data` is no list of objects.
    Tags that a product already carries are replaced.
    """
    parsed = docs.withColumn("v", F.try_parse_json("body")).withColumn(
        "products", F.try_variant_get("v", "$.data", "array<map<string,variant>>"))
    bad = F.col("products").isNull() | F.exists("products", lambda p: p.isNull())
    rejects = parsed.filter(bad).select("location_id", "term", "body")
    # one expression that names the parsed list once: a filter, also one that `explode` implies, would be pushed below it
    # and parse the body again for each naming
    good = F.filter(F.array("products"), lambda ps: ps.isNotNull() & ~F.exists(ps, lambda p: p.isNull()))
    products = parsed.select("location_id", "term", F.explode_outer(F.flatten(good)).alias("p")).filter(F.col("p").isNotNull())
    own = F.map_filter("p", lambda k, _: ~k.isin("_location_id", "_search_term"))
    tags = F.create_map(F.lit("_location_id"), F.to_variant_object(F.struct(F.col("location_id").alias("x"))),
                        F.lit("_search_term"), F.to_variant_object(F.struct(F.col("term").alias("x"))))
    tags = F.transform_values(tags, lambda _, v: F.variant_get(v, "$.x", "variant"))
    tagged = products.select(
        F.col("location_id").alias("store_id"),
        F.try_variant_get(F.col("p")["productId"], "$", "string").alias("product_id"),
        F.col("term"),
        F.to_variant_object(F.map_concat(own, tags)).alias("raw_payload"),
    )
    return tagged, rejects


# ---------------------------------------------------------------------------
# X15 / X16 / X17 writes
# ---------------------------------------------------------------------------


def append(df: DataFrame, path: str, dry_run: bool = False, partition_by: list[str] | None = None) -> int:
    """One distributed append (task-level writers); returns the number of rows, written or, in a dry run, counted."""
    if dry_run:
        return df.count()
    rows = Observation("append")
    writer = df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(rows.get["n"])


def append_once(df: DataFrame, path: str, key: str = "load_id", partition_col: str | None = None,
                dry_run: bool = False) -> int:
    """X15, repeatable: append the rows whose `key` the table does not hold yet; returns how many.

    A row's key must not change from run to run, and equal keys must be in the same partition: then only the
    partitions that `df` has are looked up.  Of rows of `df` with the same key one is
    appended; rows without a key are an error, as they could never be told apart.
    `df` is read for its keys first and then for its rows.
    """
    spark = df.sparkSession
    repeated, missing = repeated_keys(df, key)
    if missing:
        raise ValueError(f"rows without {key} cannot be appended once")
    fresh = df.dropDuplicates([key]) if repeated else df
    if _exists(spark, path):
        held = spark.read.parquet(path)
        if partition_col:
            parts = df.select(F.col(partition_col).alias("_part")).distinct()
            held = held.join(parts, held[partition_col].eqNullSafe(parts["_part"]), "left_semi")
        fresh = fresh.join(held.select(F.col(key).alias("_held")), F.col(key) == F.col("_held"), "left_anti")
    if partition_col and not dry_run:
        fresh = fresh.repartitionByRange(partition_col, key)  # few files a partition value, and a value may take many tasks
    return append(fresh, path, dry_run, [partition_col] if partition_col else None)


def repeated_keys(df: DataFrame, key: str) -> tuple[bool, bool]:
    """Whether a key comes more than once, and whether a row has none: only hashes of keys are shuffled.  Two keys of
    one hash count as repeated, which is harmless: then whole rows are shuffled to drop what there may be."""
    hashed = df.select(F.xxhash64(key).alias("_h"), F.col(key).isNull().alias("_none"))
    found = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"), F.max("_none").alias("_none")).agg(
        F.max("_n").alias("most"), F.max("_none").alias("none")).first()
    return (found["most"] or 0) > 1, bool(found["none"])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has been written, by the file system that Spark uses for the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _spread(df: DataFrame, partition_col: str, sort_cols: list[str]) -> DataFrame:
    """Ranges of (partition value, sort columns): a day may take many tasks, and a task few days."""
    return df.repartitionByRange(partition_col, *sort_cols).sortWithinPartitions(partition_col, *sort_cols)


def overwrite_partitions(df: DataFrame, path: str, partition_col: str,
                         sort_cols: tuple[str, ...] = ("item_id", "store_id")) -> None:
    """Replace only the partitions present in `df` (dynamic partition overwrite); idempotent on retry."""
    (_spread(df, partition_col, [c for c in sort_cols if c in df.columns]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


def write_clustered(df: DataFrame, path: str, partition_col: str, sort_cols: list[str],
                    mode: str = "overwrite") -> None:
    """Partition by date and sort within files, so parquet min/max statistics skip row groups."""
    _spread(df, partition_col, sort_cols).write.mode(mode).partitionBy(partition_col).parquet(path)


def curve_cuts(df: DataFrame, cols: list[str], bits: int = 8) -> dict[str, list]:
    """Up to 2^bits - 1 cut points per column, ascending: the values of smallest hash among its distinct ones.

    They part the distinct values into about equal ranks; only the cuts come to the driver.
    """
    most = (1 << bits) - 1
    return {c: sorted(r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct()
                      .orderBy(F.xxhash64(c), c).limit(most).collect()) for c in cols}


def curve_key(cuts: dict[str, list], bits: int = 8) -> Column:
    """The place on a Z-order curve: each column's share of cuts not above its value, as `bits` bits, interleaved.

    Rows near each other on the curve are near in every column, so each column's
    minima and maxima of a row group span a small part of its values.  Nulls come first.
    """
    def rank(c: str) -> Column:
        values = F.array(*[F.lit(v) for v in cuts[c]])

        def step(found: Column, by: Column) -> Column:
            value = F.get(values, found + by - 1)  # past the end: null, which is not <=
            return F.when(value <= F.col(c), found + by).otherwise(found)

        halves = F.array(*[F.lit(1 << k) for k in range(bits - 1, -1, -1)])
        found = F.aggregate(halves, F.lit(0), step) if cuts[c] else F.lit(0)
        return F.floor(found * (1 << bits) / (len(cuts[c]) + 1))  # few values spread over all bits, too

    key = F.lit(0).cast("long")
    for j, c in enumerate(cuts):
        at = rank(c).cast("long")
        for b in range(bits):
            bit = F.shiftright(at, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(cuts) + len(cuts) - 1 - j))
    return key


def write_curve_clustered(df: DataFrame, path: str, cols: list[str], bits: int = 8, files: int | None = None,
                          mode: str = "overwrite") -> None:
    """X17 for filters on any of `cols`: files and row groups follow a Z-order curve over all of them.

    A sort by several columns narrows only the first one's ranges.  Equal keys (a hot item in one store, say) may
    take several tasks, since rows are dealt by ranges of (key, hash of the row).
    """
    if not 1 <= len(cols) * bits <= 62:
        raise ValueError("the columns' bits must fit a long")
    keyed = df.withColumn("_key", curve_key(curve_cuts(df, cols, bits), bits)).withColumn("_spread", F.xxhash64(*df.columns))
    parts = [files] if files else []
    (keyed.repartitionByRange(*parts, "_key", "_spread").sortWithinPartitions("_key", *cols).drop("_key", "_spread")
     .write.mode(mode).parquet(path))


def materialize(df: DataFrame, name: str, as_table_path: str | None = None) -> DataFrame:
    """View (lazy temp view) or table (written and read back, cutting lineage)."""
    if as_table_path is None:
        df.createOrReplaceTempView(name)
        return df
    df.write.mode("overwrite").parquet(as_table_path)
    out = df.sparkSession.read.parquet(as_table_path)
    out.createOrReplaceTempView(name)
    return out

