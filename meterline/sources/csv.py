"""Trip and zone CSV readers.

The trip CSV is read as all-string columns by header name (the loader coerces every field itself), trimmed,
blank lines skipped, and empty fields kept as empty text (not NULL) exactly like a JS CSV parser returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import RAW_TRIP_COLUMNS
from ..functions.parsing import parse_int, string_or_null
from ..session import written


def _read_header_csv(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("enforceSchema", False)  # a file whose header differs ends the read instead of shifting columns
            .csv(path))


def scan_trips_csv(spark: SparkSession, csv_path: str, numbered: bool = True, path: str | None = None) -> DataFrame:
    """The trips of ``csv_path``, numbered in file order; ``path`` as in ``number_rows``."""
    raw = _read_header_csv(spark, csv_path)
    present = set(raw.columns)
    cols = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in present else F.lit("").alias(c)
            for c in RAW_TRIP_COLUMNS]
    df = raw.select(*cols)
    return number_rows(df, file_order=True, path=path) if numbered else df


def number_rows(df: DataFrame, col: str = "row_num", file_order: bool = False, path: str | None = None) -> DataFrame:
    """1-based row number in input order, contiguous across partitions or files.

    The frame is computed once and written with the place of each row (partition, and file and offset for a bare
    file scan), so every later step means the same rows. Blocks of rows (one per partition or file split) are counted;
    the count before each block plus the place inside it is the number. ``file_order`` orders blocks by file name
    and offset, else they stand in partition order (the ranges of a sorted frame). The written frames stand under ``path``,
    which the caller removes when the result has been used; without it, in the shared folder.
    """
    blk = ["_ml_file", "_ml_start", "_ml_pid"] if file_order else ["_ml_pid"]
    tagged = df
    if file_order:
        tagged = tagged.withColumn("_ml_file", F.input_file_name()).withColumn("_ml_start", F.input_file_block_start())
    tagged = written(tagged.withColumn("_ml_pid", F.spark_partition_id()).withColumn("_ml_mid", F.monotonically_increasing_id()), "numbered", path)
    blocks = tagged.groupBy(*blk).agg(F.count(F.lit(1)).alias("_ml_n"), F.min("_ml_mid").alias("_ml_first"))
    if file_order:  # blocks in file order get consecutive numbers themselves
        plain = {c: f"b{c}" for c in blocks.columns}
        blocks = number_rows(blocks.orderBy(*blk).withColumnsRenamed(plain), "_ml_block", path=path).withColumnsRenamed({v: k for k, v in plain.items()})
    else:
        blocks = blocks.withColumn("_ml_block", F.col("_ml_pid"))
    # one row per block, that is per partition or split of a file: the rows themselves are not dealt by block
    numbered = tagged.join(F.broadcast(_offsets(blocks).select(*blk, "_ml_first", "_ml_off")), blk)
    pos = F.col("_ml_mid") - F.col("_ml_first")
    return numbered.select((F.col("_ml_off") + pos + 1).cast("bigint").alias(col), *[c for c in df.columns if c != col])


def _offsets(blocks: DataFrame, group: int = 1024) -> DataFrame:
    """``_ml_off``: the rows before each block. Running sums inside groups of blocks, then over the groups' totals, so
    the only window without a partition sees one row per ``group`` blocks."""
    blocks = blocks.withColumn("_ml_group", F.floor(F.col("_ml_block") / group))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_ml_n").over(before.partitionBy("_ml_group").orderBy("_ml_block")), F.lit(0))
    totals = blocks.groupBy("_ml_group").agg(F.sum("_ml_n").alias("_ml_total"))
    totals = totals.select("_ml_group", F.coalesce(F.sum("_ml_total").over(before.orderBy("_ml_group")), F.lit(0)).alias("_ml_base"))
    return blocks.withColumn("_ml_in", inside).join(totals, "_ml_group").withColumn("_ml_off", F.col("_ml_base") + F.col("_ml_in"))


def scan_zones_csv(spark: SparkSession, csv_path: str, numbered: bool = False, path: str | None = None) -> DataFrame:
    """Zone lookup: id int, empty text → NULL; 'N/A' stays a string. ``numbered`` adds row_num in file order."""
    raw = _read_header_csv(spark, csv_path)
    if numbered:
        raw = number_rows(raw, file_order=True, path=path)
    return raw.select(
        *(["row_num"] if numbered else []),
        parse_int("LocationID").cast("int").alias("id"),
        string_or_null("Borough").alias("borough"),
        string_or_null("Zone").alias("zone_name"),
        string_or_null("service_zone").alias("service_zone"),
    )
