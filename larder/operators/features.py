"""Calendar features, labels, feature matrix and ordered split.

The split reproduces a positional 80/20 split after sorting by
(item, store, date, load_id) without a single-partition global sort: a range
partitioned, sorted table is written once, and a row's number is its place in
its partition plus the rows of the partitions before it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.marts import HOT_SERIES_ROWS, SERIES, TIEBREAK, skew_safe_series_window
from larder.session import store

FEATURE_COLS = (
    "price_delta_7d", "price_delta_30d", "price_vs_90d_avg", "is_on_sale",
    "day_of_week", "week_of_month", "month",
)


def day_of_week(d: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(d)


def week_of_month(d: Column) -> Column:
    return F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1


def calendar_features(df: DataFrame, date_col: str = "price_date", with_year: bool = False) -> DataFrame:
    """M1: day of week, week of month, month (+ year for the forecaster)."""
    d = F.col(date_col)
    cols = {"day_of_week": day_of_week(d), "week_of_month": week_of_month(d), "month": F.month(d)}
    if with_year:
        cols["year"] = F.year(d)
    return df.withColumns(cols)


def build_labels(history: DataFrame, horizon: int = 7, drop_pct: str = "0.10", tiebreak: str = TIEBREAK,
                 hot_series_rows: int | None = HOT_SERIES_ROWS) -> DataFrame:
    """Label 1 when the price `horizon` rows ahead is at least `drop_pct` lower.

    Compared on decimals (future - price <= -pct * price), so an exact 10 % drop
    is positive; a zero price is never positive; the last `horizon` rows of each
    series (no future price) are dropped.  Hot series are computed in chunks.
    """
    def compute(df: DataFrame, w) -> DataFrame:
        return df.withColumn("future_price_7d", F.lead("regular_price", horizon).over(w))

    out = skew_safe_series_window(history, compute, before=0, after=horizon, hot_rows=hot_series_rows,
                                  tiebreak=tiebreak).filter(F.col("future_price_7d").isNotNull())
    pct = F.lit(Decimal(drop_pct))
    positive = (F.col("regular_price") != 0) & (
        (F.col("future_price_7d") - F.col("regular_price")) <= -pct * F.col("regular_price")
    )
    return out.withColumn("label", F.when(positive, 1).otherwise(0))


def feature_matrix(df: DataFrame, cols=FEATURE_COLS) -> DataFrame:
    """M3: feature columns as doubles with NULL -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def ordered_split(df: DataFrame, test_fraction: float = 0.2, tiebreak: str = TIEBREAK,
                  partitions: int | None = None) -> DataFrame:
    """M4: positional split (first ceil-complement rows train, last ceil(f*n) rows test).

    Order: item_id, store_id, price_date, tiebreak; nulls come first.  Adds
    `row_index` (0-based) and `split` in {'train', 'test'}.

    `df` is range partitioned by the whole order (so a series of any size is spread),
    sorted and written once, each row with its partition and place.  The rows
    before a partition are prefix sums over the partitions, whose number is a
    parameter, so their table is broadcast; nothing is sorted or joined by series again.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*SERIES, "price_date", tiebreak]
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = store(placed, "ordered")
    part = F.shiftright("_id", 33)  # the documented layout of these ids: the partition above 33 bits of place
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most `partitions` rows
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy()).alias("_total"))
    indexed = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(
        "row_index", F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    n_test = F.ceil(F.col("_total").cast("double") * F.lit(test_fraction))
    split = F.when(F.col("row_index") >= F.col("_total") - n_test, F.lit("test")).otherwise(F.lit("train"))
    return indexed.withColumn("split", split).drop("_id", "_part", "_before", "_total")


def class_balance(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Negatives / max(positives, 1) (positive-class weight)."""
    return labelled.agg(
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("negatives"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
    ).select(
        "negatives", "positives",
        (F.col("negatives").cast("double") / F.greatest(F.col("positives"), F.lit(1)).cast("double"))
        .alias("scale_pos_weight"),
    )

