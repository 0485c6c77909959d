"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. language ID: documents without a recognisable language go;
2. exact dedup: one document of equal texts stays;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing: documents are repeated to temperature weights of their sources, every source at least once whole;
5. packing: documents are placed in length buckets and token-budget batches.

All stages but the last return the columns of ``documents``.  Shuffle files go as each query of a stage ends, and
:func:`run` deletes a stage's tables, its input included, once its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scanpress.llm import dedup, jaccard, langid, mixing, packing
from scanpress.llm.common import materialize, prepared, scratch_released, shuffles_released, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with shuffles_released(prepared(spark)):
        return langid.drop_unidentified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with shuffles_released(prepared(spark)):
        return dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with shuffles_released(prepared(spark)):
        return jaccard.keep_one_per_component(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with shuffles_released(prepared(spark)):
        return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with shuffles_released(prepared(spark)):
        return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained prototypes, the dynamic program and hashed permutations have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with shuffles_released(spark), scratch_released(spark) as release:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            release(docs)
    return docs
