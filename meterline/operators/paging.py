"""Seek paging over the error log: cursors, and an index of how many rows its files hold.

The list is ordered by created_at (newest first), row_num (highest first), err_type and source. A load's log is written in
ranges of row_num, so each file holds one stretch of its load's part of the list.
"""

from __future__ import annotations

import base64
import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .errorlog import soft_only

Place = tuple[dt.datetime, int, str, str]


def in_ranges(errors: DataFrame) -> DataFrame:
    """The log in ranges of row_num, sorted, so that files and row groups hold stretches of the list. Its rows are made twice (the
    ranges are found from a sample): hand over ``flag_rows`` and finish them afterwards."""
    return errors.repartitionByRange(F.col("row_num").desc()).sortWithinPartitions(F.col("row_num").desc(), "err_type", "source")


def cursor() -> Column:
    """The place of a row of the log in the list, as opaque text."""
    place = F.to_json(F.array(F.unix_micros("created_at").cast("string"), F.col("row_num").cast("string"), F.col("err_type"), F.col("source")))
    return F.translate(F.base64(place.cast("binary")), "\r\n", "")  # in one line


def read_cursor(text: str) -> Place:
    try:
        micros, row, err_type, source = json.loads(base64.b64decode(text, validate=True))
        return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=int(micros)), int(row), str(err_type), str(source)
    except (ValueError, TypeError) as e:
        raise ValueError("not a cursor of this list") from e


def follows(place: Place) -> Column:
    """True for rows behind ``place``. The first conditions are plain comparisons that a scan can skip files by."""
    created, row, err_type, source = (F.lit(x) for x in place)
    tie = (F.col("err_type") > err_type) | ((F.col("err_type") == err_type) & (F.col("source") > source))
    upto = (F.col("created_at") < created) | ((F.col("created_at") == created) & (F.col("row_num") <= row))
    return upto & ((F.col("created_at") < created) | (F.col("row_num") < row) | tie)


def page_index(errors: DataFrame) -> DataFrame:
    """One row per file of a stored log and type of flag: created_at, the range of its row numbers, and its rows in the list."""
    return (soft_only(errors).groupBy(F.col("_metadata.file_name").alias("file"), "err_type", "created_at")
            .agg(F.min("row_num").alias("low"), F.max("row_num").alias("high"), F.count(F.lit(1)).alias("n")))


def page_end(index: DataFrame, limit: int, start: Place | None, flag_type: str | None) -> tuple[dt.datetime, int] | None:
    """(created_at, row_num) down to which at least ``limit`` rows follow ``start``; None if the index can't tell. Only files wholly
    behind ``start`` are counted; as each has a row, the first ``limit`` of them are enough."""
    blocks = index if flag_type is None else index.where(F.col("err_type") == F.lit(flag_type))
    if start is not None:
        created, row = F.lit(start[0]), F.lit(start[1])
        blocks = blocks.where((F.col("created_at") < created) | ((F.col("created_at") == created) & (F.col("high") < row)))
    order = [F.desc("created_at"), F.desc("low"), F.asc("err_type"), F.asc("file")]
    first = blocks.orderBy(*order).limit(limit)
    upto = F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # over ``limit`` rows at most
    end = first.withColumn("upto", upto).where(F.col("upto") >= limit).orderBy("upto").select("created_at", "low").first()
    return None if end is None else (end.created_at, end.low)
