"""Row coercion and the hard / soft data-quality flags, as one narrow projection (no shuffle).

Output keeps ``row_num`` and the raw text fields (as the struct ``raw``) and adds the coerced trip columns, ``hard_code`` (NULL for rows that stay)
and ``raw_flags``: an ``array<struct>`` of the flags raised on the raw row, in evaluation order. Soft flags
are raised for every row, including rows that are later excluded or found to be duplicates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import column_cache
from ..config import PEAK_HOURS, RAW_TRIP_COLUMNS, TIMESTAMP_FORMATS, VALID_RATE_CODES
from ..functions.parsing import (blank_aware_float, float_or_zero, int_or_null, js_number_text, parse_float,
                                 parse_int, parse_timestamp, string_or_null)

FLAG_FIELDS = ("err_type", "action", "reason", "field_name", "orig_value")
FLAGS_TYPE = f"array<struct<{','.join(f'{f}:string' for f in FLAG_FIELDS)}>>"


def flag_record(code: str, action: str, reason: Column, field: str, value: Column) -> Column:
    """One flag as a struct; ``orig_value`` is ``String(value ?? '')``."""
    return F.struct(F.lit(code).alias("err_type"), F.lit(action).alias("action"), reason.alias("reason"),
                    F.lit(field).alias("field_name"), F.coalesce(value, F.lit("")).alias("orig_value"))


def flag_if(cond: Column, code: str, action: str, reason: Column, field: str, value: Column) -> Column:
    """An array of the one flag where ``cond`` holds, else an empty one."""
    return F.when(cond, F.array(flag_record(code, action, reason, field, value))).otherwise(F.array().cast(FLAGS_TYPE))


def collect_flags(candidates: Iterable[Column]) -> Column:
    """The raised flags of all candidates in one array: one pass, no unions. A concat runs as generated code; a filter with a
    lambda is interpreted, and with it every condition and text that its array holds."""
    return F.concat(*candidates)


def normalise(raw: DataFrame, timestamp_formats: Iterable[str] = TIMESTAMP_FORMATS) -> DataFrame:
    staged_cols, final_cols = _normalise_columns(tuple(timestamp_formats))
    return raw.select("*", *staged_cols).select(*final_cols)


@column_cache
def _normalise_columns(timestamp_formats: tuple):
    c = F.col
    pickup = parse_timestamp("tpep_pickup_datetime", timestamp_formats)
    dropoff = parse_timestamp("tpep_dropoff_datetime", timestamp_formats)
    staged = [
        pickup.alias("_pickup"), dropoff.alias("_dropoff"),
        parse_int("passenger_count").alias("_passengers"),
        parse_float("trip_distance").alias("_distance"),
        parse_float("fare_amount").alias("_fare"),
        parse_float("tip_amount").alias("_tip"),
        parse_float("total_amount").alias("_total"),
        parse_int("RatecodeID").alias("_rate"),
    ]
    bad_dt = c("_pickup").isNull() | c("_dropoff").isNull()
    before = ~bad_dt & (c("_dropoff") <= c("_pickup"))
    hard = [
        flag_if(bad_dt, "BAD_DATETIME", "excluded", F.lit("unparseable pickup or dropoff datetime"),
                "tpep_pickup_datetime", c("tpep_pickup_datetime")),
        flag_if(before, "DROPOFF_BEFORE_PICKUP", "excluded",
                F.concat(F.lit("dropoff "), c("tpep_dropoff_datetime"), F.lit(" is not after pickup "),
                         c("tpep_pickup_datetime")),
                "tpep_dropoff_datetime", c("tpep_dropoff_datetime")),
    ]
    pas, dist = c("_passengers"), c("_distance")
    pas_t, dist_t = js_number_text(pas), js_number_text(dist)
    fare_t, total_t, tip_t = js_number_text(c("_fare")), js_number_text(c("_total")), js_number_text(c("_tip"))
    rate_t = js_number_text(c("_rate"))

    def txt(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    soft = [
        flag_if(pas <= 0, "ZERO_PASS", "retained", txt("passenger_count is ", pas_t, " (≤ 0)"), "passenger_count", pas_t),
        flag_if(pas > 8, "HIGH_PASS", "retained", txt("passenger_count is ", pas_t, " (> 8)"), "passenger_count", pas_t),
        flag_if(dist <= 0, "ZERO_DIST", "retained", txt("trip_distance is ", dist_t, " (≤ 0)"), "trip_distance", dist_t),
        flag_if(dist > 100, "LARGE_DIST", "retained", txt("trip_distance is ", dist_t, " (> 100 miles)"), "trip_distance", dist_t),
        flag_if(c("_fare") < 0, "NEG_FARE", "retained", txt("fare_amount is ", fare_t, " (negative)"), "fare_amount", fare_t),
        flag_if(c("_total") < 0, "NEG_TOTAL", "retained", txt("total_amount is ", total_t, " (negative)"), "total_amount", total_t),
        flag_if(c("_tip") < 0, "NEG_TIP", "retained", txt("tip_amount is ", tip_t, " (negative)"), "tip_amount", tip_t),
        flag_if(c("_rate").isNull() | ~c("_rate").isin(*VALID_RATE_CODES), "BAD_RATE_CODE", "retained",
                txt("RatecodeID ", rate_t, " is non-standard"), "RatecodeID", rate_t),
    ]
    hard_code = F.when(bad_dt, F.lit("BAD_DATETIME")).when(before, F.lit("DROPOFF_BEFORE_PICKUP"))
    excluded = hard_code.isNotNull()
    kept_ts = F.when(~excluded, c("_pickup"))
    hour = F.hour(kept_ts)
    final = [
        c("row_num"),
        F.struct(*[c(name) for name in RAW_TRIP_COLUMNS]).alias("raw"),
        int_or_null("VendorID").try_cast("int").alias("vendor"),
        kept_ts.alias("pickup_time"),
        F.when(~excluded, c("_dropoff")).alias("dropoff_time"),
        pas.try_cast("int").alias("passengers"),
        F.coalesce(dist, F.lit(0.0)).alias("distance"),
        c("_rate").try_cast("int").alias("rate_id"),
        string_or_null("store_and_fwd_flag").alias("store_fwd"),
        int_or_null("PULocationID").try_cast("int").alias("pickup_zone"),
        int_or_null("DOLocationID").try_cast("int").alias("dropoff_zone"),
        int_or_null("payment_type").try_cast("int").alias("payment_type"),
        F.coalesce(c("_fare"), F.lit(0.0)).alias("fare"),
        float_or_zero("extra").alias("extra"),
        float_or_zero("mta_tax").alias("tax"),
        F.coalesce(c("_tip"), F.lit(0.0)).alias("tip"),
        float_or_zero("tolls_amount").alias("tolls"),
        float_or_zero("improvement_surcharge").alias("surcharge"),
        F.coalesce(c("_total"), F.lit(0.0)).alias("total"),
        blank_aware_float("congestion_surcharge").alias("congestion"),
        hour.alias("hour_of_day"),
        (F.dayofweek(kept_ts) - 1).alias("day_of_week"),
        F.when(hour.isNotNull(), hour.isin(*PEAK_HOURS)).alias("is_peak"),
        hard_code.alias("hard_code"),
        collect_flags(hard + soft).alias("raw_flags"),
    ]
    return staged, final


def hard_exclusion(norm: DataFrame) -> DataFrame:
    """Rows that can become trips (no BAD_DATETIME / DROPOFF_BEFORE_PICKUP)."""
    return norm.where(F.col("hard_code").isNull())
