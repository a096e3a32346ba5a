"""The corpus pipeline: quality classifier, language ID, SimHash near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. The first three return rows of ``documents`` with all their columns; the last returns packed pieces. Each stage bounds
the batches of its Python workers itself, as stages are also run one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import langid, packing, quality, simhash
from meterline.llm.common import bounded_batches, read_table, written
from meterline.llm.queries import TOKENIZER, language_rows, quality_rows

#: SQL can express none of the learned stages; tests hold the stages against brute force instead.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose quality score is under the threshold."""
    bounded_batches(spark)
    rows, labels = quality_rows(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, quality.fit(rows, labels))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter and those that no learned language explains."""
    bounded_batches(spark)
    return langid.keep_known(docs, langid.fit(language_rows(docs)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    bounded_batches(spark)
    return simhash.keep_first(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts and packs what is left into windows."""
    bounded_batches(spark)
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
