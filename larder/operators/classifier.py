"""Buy-now classifier: thresholds, exact binary metrics, training and scoring.

Metrics are ratios of integer counts (precision, recall, F1, and AUC by the
Mann-Whitney rank sum with average ranks for ties), so they are computed as
exact decimals and rounded HALF_UP to 4 digits.  AUC needs the number of
negatives below each distinct score; those prefix sums run per score bucket
(probabilities lie in [0, 1]) with bucket offsets from a bucket-level prefix
sum, so no window ever holds all distinct scores in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators import boosting
from larder.operators import features as fe
from larder.operators.marts import latest_snapshot
from larder.session import store

# Decision thresholds and model constants.
BUY_NOW_THRESHOLD = 0.6
WAIT_THRESHOLD = 0.4
MODEL_VERSION = "1.0.0"
AUC_BUCKETS = 1024

HISTORY_INPUT = (*fe.SERIES, "price_date", fe.TIEBREAK, "regular_price", "is_on_sale")  # of a history's input, what models read


def recommend(prob: Column) -> Column:
    """BUY_NOW at p >= 0.6, WAIT below 0.4, NEUTRAL otherwise."""
    return (
        F.when(prob >= F.lit(BUY_NOW_THRESHOLD), F.lit("BUY_NOW"))
        .when(prob < F.lit(WAIT_THRESHOLD), F.lit("WAIT"))
        .otherwise(F.lit("NEUTRAL"))
    )


def _ratio4(num: Column, den: Column) -> Column:
    """round(num / den, 4) exactly on decimals; 0 when den = 0 (zero_division=0)."""
    q = F.round(num.cast("decimal(20,0)") / F.nullif(den, F.lit(0)).cast("decimal(20,0)"), 4)
    return F.coalesce(q, F.lit(0)).cast("decimal(10,4)")


def binary_metrics(scored: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, f1, auc_roc (one row), rounded to 4; AUC 0 for a single class.

    The input is read once, into counts per distinct score; the confusion counts
    and the rank sum (sum over scores of pos * (2 * negatives below + neg)) both
    come from those.  Rows without a score or label take no part.
    """
    by_score = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
    ).withColumn("b", F.least(F.greatest(F.floor(F.col("s") * AUC_BUCKETS), F.lit(0)), F.lit(AUC_BUCKETS - 1)))
    # At most AUC_BUCKETS rows: the bucket-level prefix sum is bounded.
    bucket_off = by_score.groupBy("b").agg(F.sum("neg").alias("bneg")).select("b", F.coalesce(
        F.sum("bneg").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("boff"))
    within = F.coalesce(
        F.sum("neg").over(Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = by_score.join(F.broadcast(bucket_off), "b").withColumn("below", F.col("boff") + within)
    hit = F.col("s") >= F.lit(threshold)
    total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    sums = ranked.agg(
        total("pos", hit).alias("tp"), total("neg", hit).alias("fp"), total("pos", ~hit).alias("fn"),
        total("neg", ~hit).alias("tn"),
        F.sum(F.col("pos").cast("decimal(38,0)") * (2 * F.col("below") + F.col("neg"))).alias("auc_num"))
    p, n = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    auc_value = F.when((p > 0) & (n > 0), _ratio4(F.col("auc_num"), 2 * p * n)).otherwise(
        F.lit(0).cast("decimal(10,4)"))
    return sums.select(
        _ratio4(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio4(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio4(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        auc_value.alias("auc_roc"),
    )


def training_frame(history: DataFrame, lookback_days: int | None = None, as_of=None) -> DataFrame:
    """Rows within the lookback (None: all of them), with calendar features and labels."""
    if lookback_days is not None:
        cutoff = F.date_sub(F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"), lookback_days)
        history = history.filter(F.col("price_date") >= cutoff)
    return fe.build_labels(fe.calendar_features(history))


def split_frame(history: DataFrame, lookback_days: int | None = None, as_of=None, split: str = "positional") -> DataFrame:
    """The training frame with its split and its features as doubles, written once, without the columns that models do not read.

    `split="positional"` is the ordered 80/20 split; `split="time"` holds out the latest 20 % of dates.
    """
    used = dict.fromkeys((*HISTORY_INPUT, *fe.FEATURE_COLS))
    data = training_frame(history.select(*[c for c in history.columns if c in used]), lookback_days, as_of)
    if split == "positional":
        return fe.feature_matrix(fe.ordered_split(data))
    if split != "time":
        raise ValueError(f"unknown split {split!r}")
    data = store(data, "labelled")
    cut = data.select(F.percentile_approx("price_date", 0.8)).scalar()
    return fe.feature_matrix(data.withColumn("split", F.when(F.col("price_date") > cut, "test").otherwise("train")))


def train_classifier(history: DataFrame, lookback_days: int | None = None, as_of=None, split: str = "positional",
                     rounds: int = 200, depth: int = 4, rate: float = 0.05, patience: int | None = None):
    """M5: weighted second-order boosted trees (200 of depth 4 at rate 0.05), positives weighted by the class ratio.

    All of the history is trained on unless a caller names a lookback (the jobs name 90 days), and all `rounds` trees are
    grown unless it names a patience.  Returns (model, metrics DataFrame).  Empty input returns (None, None).  `history` is read by
    the labels' windows only; what follows reads the stored frame, and the trees its cells.
    """
    data = split_frame(history, lookback_days, as_of, split)
    train = data.filter(F.col("split") == "train")
    weight = fe.class_balance(train).first()
    if weight["negatives"] is None:
        return None, None
    model = boosting.fit_boosted_trees(data, fe.FEATURE_COLS, "label", F.col("split") == "test", rounds, depth, rate,
                                       positive_weight=weight["scale_pos_weight"], patience=patience)
    test = store(score(model, data.filter(F.col("split") == "test")).select("buy_now_probability", "label"), "scored")
    return model, binary_metrics(test, "buy_now_probability", "label", 0.5)


def score(model, df: DataFrame) -> DataFrame:
    """Probability of the positive class as a column."""
    return df.withColumn("buy_now_probability", model.probability())


def buy_signals(history: DataFrame, model, forecasts: DataFrame | None = None) -> DataFrame:
    """Latest snapshot -> features -> score -> threshold -> attach 7/14-day forecasts."""
    snap = fe.calendar_features(latest_snapshot(history))
    scored = score(model, snap)
    out = scored.select(
        "item_id", "store_id", F.col("price_date").alias("signal_date"), "regular_price",
        F.round(F.col("buy_now_probability"), 4).cast("decimal(6,4)").alias("buy_now_probability"),
        recommend(F.col("buy_now_probability")).alias("recommendation"),
        F.lit(MODEL_VERSION).alias("model_version"),
    )
    return attach_forecasts(out, forecasts)


def attach_forecasts(signals: DataFrame, forecasts: DataFrame | None) -> DataFrame:
    """Left join of (item, store) forecasts, with the bounds of the nearer one if they have them;
    missing series give NULL predictions."""
    if forecasts is None:
        return signals.withColumns({
            "predicted_price_7d": F.lit(None).cast("decimal(10,2)"),
            "predicted_price_14d": F.lit(None).cast("decimal(10,2)"),
        })
    names = {"yhat_7": "predicted_price_7d", "yhat_14": "predicted_price_14d",
             "yhat_lower": "confidence_interval_lower", "yhat_upper": "confidence_interval_upper"}
    f = forecasts.select("item_id", "store_id", *[F.col(c).cast("decimal(10,2)").alias(name) for c, name in names.items()
                                                  if c in forecasts.columns])
    return signals.join(f, ["item_id", "store_id"], "left")
