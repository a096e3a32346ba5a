"""Sorting, top-N, ranking and paging."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.csv import number_rows


def _leading_int(value) -> int:
    """The whole number that a text begins with, else 0."""
    found = re.match(r"\s*([+-]?\d+)", "" if value is None else str(value))
    return int(found[1]) if found else 0


def clamp_limit(value, default: int, maximum: int) -> int:
    """``min(leading number or default, maximum)``: the API's own limit rule. What was applied is a field of the endpoint's
    meta row; a negative limit is rejected."""
    n = _leading_int(value) or default
    if n < 0:
        raise ValueError(f"limit must be positive, got {value!r}")
    return min(n, maximum)


def clamp_offset(value) -> int:
    return max(_leading_int(value), 0)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY … LIMIT n (planned as TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def rank_column(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based rank for an already limited (small) result."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def stable_sort(df: DataFrame, keys: Sequence[Column], position: str | None = None,
                tie_col: str = "row_num") -> DataFrame:
    """Sort on ``keys``; equal keys keep input order (tie-break on ``tie_col``). With ``position`` the global
    1-based position is added from the sorted rows as written once (no single-task window)."""
    ordered = df.orderBy(*keys, F.col(tie_col).asc())
    return number_rows(ordered, position) if position else ordered


def sort_by_any_column(df: DataFrame, column: str, descending: bool = True, collation: str = "UNICODE",
                       tie_col: str | None = None) -> DataFrame:
    """Text columns sort with a locale-aware collation, numbers by value; stable when ``tie_col`` is given."""
    field = df.schema[column].dataType.simpleString()
    key = F.collate(F.col(column), collation) if field == "string" else F.col(column)
    key = key.desc() if descending else key.asc()
    return df.orderBy(key, *([F.col(tie_col).asc()] if tie_col else []))


def paginate(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0):
    """(page, meta): ``ORDER BY … LIMIT l OFFSET o`` and one-row ``total, limit, offset, count, has_more``."""
    page = df.orderBy(*order).offset(offset).limit(limit)
    total = df.agg(F.count(F.lit(1)).alias("total"))
    meta = total.select(
        "total", F.lit(limit).cast("bigint").alias("limit"), F.lit(offset).cast("bigint").alias("offset"),
        F.greatest(F.least(F.col("total") - offset, F.lit(limit)), F.lit(0)).cast("bigint").alias("count"))
    meta = meta.withColumn("has_more", (F.lit(offset) + F.col("count")) < F.col("total"))
    return page, meta


def result_with_meta(df: DataFrame, **extra):
    """(rows, one-row meta): ``count`` of the rows plus fixed fields such as limit or granularity."""
    told = [F.lit(v).cast("bigint" if isinstance(v, int) else "string").alias(k) for k, v in extra.items()]
    return df, df.agg(F.count(F.lit(1)).alias("count")).select("*", *told)
