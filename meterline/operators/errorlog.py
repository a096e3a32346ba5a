"""The long error table: one row per raised flag.

* every raw row contributes its hard and soft flags (source 'quality', raw_data '{}');
* every kept trip contributes its post-enrichment flags twice: once as a quality record and once as an
  anomaly record with the five features and the whole raw row (source 'anomaly').

Both branches are narrow ``explode``s over already-computed arrays and are combined with ``unionByName``; texts and hashes are
made behind the union (``error_rows``), so a page renders only its own rows and a stored log renders each row once.
``err_id`` is a content hash (reproducible, unlike a random UUID); ``created_at`` is the run timestamp.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import column_cache
from ..config import HARD_FLAG_TYPES, RAW_TRIP_COLUMNS

JSON_KEEP_NULLS = {"ignoreNullFields": "false"}
#: Column of a stored log with the details as a Variant, which the writer shreds by their fields. The text stays beside it, as a
#: Variant doesn't keep the order of fields.
VARIANT = "details_v"
ERROR_LOG_COLUMNS = ("err_id", "row_num", "err_type", "details", "raw_data", "created_at", "source")


def json_build(*cols: Column) -> Column:
    """JSON object text from named columns; NULL values are written as ``null``."""
    return F.to_json(F.struct(*cols), JSON_KEEP_NULLS)


def _err_id(source: str) -> Column:
    return F.sha2(F.concat_ws("|", F.col("row_num").cast("string"), F.col("flag.err_type"), F.lit(source)), 256)


@column_cache
def _quality_details() -> Column:
    f = F.col("flag")
    return json_build(f.action.alias("action"), f.reason.alias("reason"), f.field_name.alias("field"),
                      f.orig_value.alias("original_value"))


def created_time(created_at) -> Column:
    if created_at is None:
        return F.current_timestamp()
    if isinstance(created_at, (dt.datetime, str)):
        return F.lit(created_at).cast("timestamp")
    return created_at


def explode_flags(df: DataFrame, flags_col: str, *keep) -> DataFrame:
    """One row per flag. ``explode_outer`` + a filter on the generated column, rather than ``explode``:
    with ``explode`` the optimizer infers ``size(flags) > 0`` and pushes it below the projections that
    define the array, re-evaluating the whole flag expression a second time per row."""
    out = df.select("row_num", *keep, F.explode_outer(flags_col).alias("flag"))
    return out.where(F.col("flag").isNotNull())


def quality_rows(df: DataFrame, flags_col: str, created_at=None) -> DataFrame:
    exploded = explode_flags(df, flags_col)
    return exploded.select(
        _err_id("quality").alias("err_id"), "row_num", F.col("flag.err_type").alias("err_type"),
        _quality_details().alias("details"), F.lit("{}").alias("raw_data"),
        created_time(created_at).alias("created_at"), F.lit("quality").alias("source"))


@column_cache
def _anomaly_payload(trip: str = ""):
    raw_json = json_build(*[F.col(f"{trip}raw.{c}").alias(c) for c in RAW_TRIP_COLUMNS])
    details = json_build(*[F.col(f"{trip}{c}").alias(c) for c in ("distance", "fare", "speed_mph", "duration_min", "tip_pct")])
    return raw_json, details


def post_rows(kept: DataFrame, created_at=None) -> DataFrame:
    """Both records of every post-enrichment flag of a kept trip, from one pass over ``kept``: each flag
    becomes a quality record and an anomaly record (with the five features and the raw row)."""
    raw_json, details = _anomaly_payload()
    # explode first: the JSON payloads are built only for trips that have a post flag
    exploded = explode_flags(kept, "post_flags", "raw", "distance", "fare", "speed_mph", "duration_min", "tip_pct")
    quality = F.struct(F.lit("quality").alias("source"), _quality_details().alias("details"),
                       F.lit("{}").alias("raw_data"))
    anomaly = F.struct(F.lit("anomaly").alias("source"), details.alias("details"), raw_json.alias("raw_data"))
    both = exploded.select("row_num", "flag", F.inline(F.array(quality, anomaly)))
    err_id = F.sha2(F.concat_ws("|", F.col("row_num").cast("string"), F.col("flag.err_type"), F.col("source")), 256)
    return both.select(err_id.alias("err_id"), "row_num", F.col("flag.err_type").alias("err_type"), "details",
                       "raw_data", created_time(created_at).alias("created_at"), "source")


def anomaly_rows(kept: DataFrame, created_at=None) -> DataFrame:
    return post_rows(kept, created_at).where(F.col("source") == "anomaly")


def flag_rows(norm: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of the error table before their texts and hashes are made: row_num, err_type, source, the flag and, for anomaly
    records, the trip they are made from. Sorting, moving or cutting these costs less than the finished rows."""
    trip = F.struct("raw", "distance", "fare", "speed_mph", "duration_min", "tip_pct")
    post = explode_flags(kept, "post_flags", trip.alias("trip"))
    each = F.array(F.struct(F.lit("quality").alias("source"), F.lit(None).cast(post.schema["trip"].dataType).alias("trip")),
                   F.struct(F.lit("anomaly").alias("source"), F.col("trip").alias("trip")))
    post = post.select("row_num", F.col("flag.err_type").alias("err_type"), "flag", F.inline(each))
    quality = explode_flags(norm, "raw_flags").select("row_num", F.col("flag.err_type").alias("err_type"), "flag", F.lit("quality").alias("source"),
                                                      F.lit(None).cast(post.schema["trip"].dataType).alias("trip"))
    return quality.unionByName(post)


def error_rows(flags: DataFrame, created_at=None, *more: str) -> DataFrame:
    """The finished rows of the error table from ``flag_rows``."""
    raw_json, trip_details = _anomaly_payload("trip.")
    anomaly = F.col("source") == "anomaly"
    err_id = F.sha2(F.concat_ws("|", F.col("row_num").cast("string"), F.col("err_type"), F.col("source")), 256)
    return flags.select(err_id.alias("err_id"), "row_num", "err_type", F.when(anomaly, trip_details).otherwise(_quality_details()).alias("details"),
                        F.when(anomaly, raw_json).otherwise(F.lit("{}")).alias("raw_data"), created_time(created_at).alias("created_at"), "source", *more)


def error_log(norm: DataFrame, kept: DataFrame, created_at=None) -> DataFrame:
    """Union of the error branches: quality flags of all raw rows, and the two records per post flag."""
    return error_rows(flag_rows(norm, kept), created_at)


def with_variant(errors: DataFrame) -> DataFrame:
    return errors.withColumn(VARIANT, F.try_parse_json("details"))


def soft_only(errors: DataFrame) -> DataFrame:
    """Rows the API shows: hard exclusion codes filtered out."""
    return errors.where(~F.col("err_type").isin(*HARD_FLAG_TYPES))


def json_extract_num(details: Column, key: str) -> Column:
    """``(details->>'key')::numeric`` as double; NULL when the key is absent."""
    return F.get_json_object(details, f"$.{key}").try_cast("double")
