"""A training corpus from ``documents``, stage by stage: each stage's rows are written as Parquet and read
again as the next one's documents. All stages but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinset.llm.common import bounded_batches, keep, release
from skeinset.llm.decontaminate import contamination
from skeinset.llm.queries import packed
from skeinset.llm.rules import quality_rules
from skeinset.llm.simhash import one_of_each_group
from skeinset.llm.substrings import with_repeats_removed


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the quality rules. Null and empty texts do not."""
    return bounded_batches(docs).withColumn("__r", quality_rules("text")).filter("__r.kept").drop("__r")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, linked by SimHash fingerprints of 4-word shingles that differ in 4 bits
    or fewer, the row with the smallest id.

    Rows without an id come after all others. Ids needn't be unique: one row stays of a group, not of an id.
    Texts without words, null ones too, are one group.
    """
    return one_of_each_group(bounded_batches(docs), words=4, bits=4)


def substrings_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words and more that occur elsewhere too; those with nothing
    left go. ``n_chars`` is counted anew where the text has changed. Null and empty texts have nothing to lose and stay."""
    cut = with_repeats_removed(bounded_batches(docs), window=35)
    changed = F.col("__n_removed") > 0
    out = [
        F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c
        for c in docs.columns
    ]
    return cut.filter("__n_removed = 0 or __n_removed < __n_words").select(*out)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null and empty texts hold none and stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(bounded_batches(docs), benchmark, found="__found").filter("not __found.contaminated").drop("__found")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens. A null or empty text is one
    piece, its end token."""
    return packed(bounded_batches(docs))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("near-duplicates", near_duplicates_stage),
    ("substrings", substrings_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # XXH64 and the tokenizer can't be had in SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        after = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            release(before)
        docs = before = after
    return docs
