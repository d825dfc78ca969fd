"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Edge cases, as the operators define them: a null or empty text is rejected by the quality rules; rows without an id go through
all stages; repeated rows and near copies leave one row, the least by id; very long texts are judged whole and cut by the last
stage only; empty tables give no rows; extra columns, whatever their names, are kept up to the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadweave.llm import cotraining, order_minhash, packing, pii, quality_rules
from roadweave.llm.common import table
from roadweave.runtime import attach, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    attach(spark)
    return cotraining.keep(docs, table(spark, sf_dir, "labels"))


def line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, failing lines of the others too."""
    return quality_rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    attach(spark)
    return order_minhash.dedup(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    attach(spark)
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest as packed sequences."""
    attach(spark)
    return packing.pack(stored(packing.cut(docs), "pieces"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", line_rules),
    ("near_dedup", near_dedup),
    ("pii", mask_pii),
    ("packing", best_fit_packing),
]

#: The classifier, Order MinHash and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
