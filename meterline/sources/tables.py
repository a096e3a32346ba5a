from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One of the given parquet tables (``{sf_dir}/{name}.parquet``).

    With ``spread`` (for fact tables whose rows carry per-row work) an input that yields fewer scan partitions than the cluster has cores (a single
    row-group file, say) is round-robin repartitioned to the default parallelism, so the per-row parsing
    work is not done by one task. Large inputs (more splits than cores) are left as scanned.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread_partitions(df) if spread else df


def spread_partitions(df: DataFrame, minimum: int | None = None) -> DataFrame:
    target = minimum or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
