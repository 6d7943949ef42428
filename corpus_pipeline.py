"""A training corpus from raw documents in five stages, each written as Parquet and read by the next.

quality classifier -> line de-duplication -> SimHash near-duplicates -> repeated
byte strings -> packing into sequences.  Every stage works on all that the one
before kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import lines, packing, quality, simhash, suffix
from larder.llm.common import materialize, read


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones among them, does not reject."""
    return quality.keep_quality(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier document has; none is dropped."""
    return lines.delete_common_blocks(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one of smallest doc_id.

    Rows that repeat a doc_id and its text are one document and become one row;
    rows without doc_id stay.
    """
    found = simhash.simhash_near_duplicates(docs.select("doc_id", "text"))
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("__first")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"))
    kept = rows.join(first, rows["__doc"] == first["__first"], "left_semi").dropDuplicates(["__doc", "__text"])
    return kept.unionByName(rows.where("__doc is null")).select("__row.*")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that already stand in an earlier place; none is dropped."""
    return suffix.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.op2_packing(docs)


STAGES = [
    ("quality_classifier", filter_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("suffix_array_dedup", remove_repeats),
    ("best_fit_packing", pack),
]

#: Fitted rules, fingerprints' components and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
