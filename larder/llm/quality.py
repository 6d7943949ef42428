"""Quality classifier as a sparse rule ensemble, compiled into Spark column expressions.

Statistics of each text are column expressions.  A small random forest is fitted
on labelled rows, each path from a root to a node becomes a conjunctive rule over
the statistics, a lasso logistic regression gives the rules their weights, and
the rules with a weight compile into one column expression: scoring runs no
Python and no model object.

The fit takes at most `FIT_ROWS` labelled rows, the ones with the smallest hash
of their doc_id; statistics and scores cover every row and whole texts.

Edge cases: a null text counts as empty, an empty text has statistics of zero;
a doc_id labelled more than once has its largest label; rows without doc_id are
scored but never fitted on; without rows of both labels every score is the share
of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize

FIT_ROWS, TREES, DEPTH, PENALTY, THRESHOLD = 20_000, 24, 3, 0.002, 0.3
STATISTICS = ("log_chars", "symbols", "capitals", "exclaims", "digits", "bars", "stops", "words_per_line",
              "word_chars", "distinct", "distinct_log", "line_share")


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with a struct column `stat` of the text's statistics (doubles)."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    count = lambda what: F.char_length(t) - F.char_length(F.replace(t, F.lit(what)))
    base = df.withColumn("__w", F.filter(F.split(t, r"\s+"), lambda w: w != "")).withColumn("__m", F.struct(
        F.char_length(t).cast("double").alias("n"),
        F.size("__w").cast("double").alias("w"),
        F.size(F.array_distinct("__w")).cast("double").alias("d"),
        (count("\n") + 1).cast("double").alias("l"),
        F.regexp_count(t, F.lit(r"[^\p{L}\p{N}\s.,;:!?'\"()|-]")).cast("double").alias("symbols"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("double").alias("capitals"),
        F.regexp_count(t, F.lit(r"\p{N}")).cast("double").alias("digits"),
        F.regexp_count(t, F.lit(r"[.,;:?]")).cast("double").alias("stops"),
        count("!").cast("double").alias("exclaims"),
        count("|").cast("double").alias("bars"),
    )).drop("__w")
    n, w, m = F.greatest("__m.n", F.lit(1.0)), F.greatest("__m.w", F.lit(1.0)), lambda k: F.col(f"__m.{k}")
    return base.withColumn("stat", F.struct(
        F.log1p(m("n")).alias("log_chars"), (m("symbols") / n).alias("symbols"), (m("capitals") / n).alias("capitals"),
        (m("exclaims") / n).alias("exclaims"), (m("digits") / n).alias("digits"), (m("bars") / w).alias("bars"),
        (m("stops") / w).alias("stops"), (m("w") / m("l")).alias("words_per_line"), (m("n") / w).alias("word_chars"),
        (m("d") / w).alias("distinct"), (F.log1p(m("d")) / F.log1p(w)).alias("distinct_log"),
        (m("l") / w).alias("line_share"))).drop("__m")


Rule = tuple[tuple[int, float | None, float | None], ...]  # (statistic, above, at most), sorted


@dataclass
class RuleModel:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    constant: float | None = None

    def score(self, stat: str = "stat") -> Column:
        if self.constant is not None:
            return F.lit(float(self.constant))
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule, stat), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def rule_column(rule: Rule, stat: str = "stat") -> Column:
    found = F.lit(True)
    for k, above, most in rule:
        value = F.col(f"{stat}.{STATISTICS[k]}")
        found = found & (F.lit(True) if above is None else value > above) & (F.lit(True) if most is None else value <= most)
    return found


def tree_rules(model) -> list[Rule]:
    """The distinct conjunctions that lead to the nodes of a forest."""
    rules: set[Rule] = set()

    def walk(node, bounds: dict[int, tuple[float | None, float | None]]) -> None:
        if bounds:
            rules.add(tuple((k, *bounds[k]) for k in sorted(bounds)))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        k, cut = node.split().featureIndex(), float(node.split().threshold())
        above, most = bounds.get(k, (None, None))
        walk(node.leftChild(), bounds | {k: (above, cut if most is None else min(most, cut))})
        walk(node.rightChild(), bounds | {k: (cut if above is None else max(above, cut), most)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return sorted(rules, key=str)


def fit_rules(labelled: DataFrame, label: str = "label", seed: int = 42, trees: int = TREES, depth: int = DEPTH,
              penalty: float = PENALTY) -> RuleModel:
    """Fit on rows with `stat` and a 0/1 `label`."""
    counts = {int(r[0]): r[1] for r in labelled.groupBy(label).count().collect()}  # two rows
    if not counts.get(0) or not counts.get(1):
        return RuleModel(constant=counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    rows = labelled.select(F.col(label).cast("double").alias("label"), "stat", array_to_vector(
        F.array(*[F.col(f"stat.{s}") for s in STATISTICS])).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", seed=seed, minInstancesPerNode=10).fit(rows)
    rules = tree_rules(forest)
    if not rules:
        return RuleModel(constant=counts[1] / sum(counts.values()))
    held = materialize(rows.select("label", array_to_vector(F.array(*[
        rule_column(r).cast("double") for r in rules])).alias("features")), "rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=80).fit(held)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if w])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit_quality(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> RuleModel:
    """Fit on the labelled rows of `stats` (doc_id, stat) that are not held out."""
    known = (labels.where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id")
             .agg(F.max("quality").alias("label")))
    rows = stats.join(known, "doc_id").select("doc_id", "stat", "label")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *[f"stat.{s}" for s in STATISTICS]).limit(fit_rows)
    return fit_rules(materialize(rows, "labelled"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per row of `docs`."""
    stats = materialize(with_statistics(docs.select("doc_id", "text")).select("doc_id", "stat"), "statistics")
    score = fit_quality(stats, labels).score()
    return stats.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with their own columns.

    Rows are stored once with their statistics: the scores' plan then reads columns, where each rule over
    statistics still to be computed would hold a copy of their expressions, in the driver's memory.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").alias("__text"))
    stats = materialize(with_statistics(rows, "__text").drop("__text"), "statistics")
    model = fit_quality(stats.select(F.col("__row.doc_id").alias("doc_id"), "stat"), labels)
    return stats.where(model.score() >= threshold).select("__row.*")
