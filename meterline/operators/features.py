"""Derived trip features (projections only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import column_cache
from ..functions.parsing import parse_float, parse_timestamp
from ..functions.rounding import to_fixed


def duration_ms(pickup: Column, dropoff: Column) -> Column:
    return F.unix_millis(dropoff) - F.unix_millis(pickup)


def duration_minutes_from_ms(ms: Column) -> Column:
    """Pass a column reference: the value is used more than once."""
    return F.when(ms > 0, to_fixed(ms / F.lit(60000), 2))


def speed_mph(distance: Column, duration_min: Column) -> Column:
    """distance / (rounded duration / 60); NULL when the rounded duration is 0 or distance ≤ 0."""
    # duration_min > 0 covers "not NULL, not 0, hours > 0"
    return F.when((duration_min > 0) & (distance > 0), to_fixed(distance / (duration_min / F.lit(60)), 2))


def money_per_minute(total: Column, duration_min: Column) -> Column:
    return F.when(duration_min > 0, to_fixed(total / duration_min, 4))


def tip_percentage(tip: Column, fare: Column) -> Column:
    return F.when(fare > 0, to_fixed(tip / fare * F.lit(100), 2))


def cost_per_mile(total: Column, distance: Column) -> Column:
    return F.when(distance > 0, to_fixed(total / distance, 4))


#: What ``enrich`` adds.
ENRICHED = ("duration_min", "speed_mph", "money_per_min", "tip_pct", "cost_per_mile")


def enrich(trips: DataFrame) -> DataFrame:
    """Adds duration_min, speed_mph, money_per_min, tip_pct, cost_per_mile to normalised trips."""
    ms, dur, rest = _enrich_columns()
    return trips.withColumn("_ml_ms", ms).withColumn("duration_min", dur).drop("_ml_ms").withColumns(rest)


@column_cache
def _enrich_columns():
    c = F.col
    rest = {
        "speed_mph": speed_mph(c("distance"), c("duration_min")),
        "money_per_min": money_per_minute(c("total"), c("duration_min")),
        "tip_pct": tip_percentage(c("tip"), c("fare")),
        "cost_per_mile": cost_per_mile(c("total"), c("distance")),
    }
    return duration_ms(c("pickup_time"), c("dropoff_time")), duration_minutes_from_ms(c("_ml_ms")), rest


def compute_features(df: DataFrame, pickup="pickup_datetime", dropoff="dropoff_datetime",
                     distance="trip_distance", total="total_amount", tip="tip_amount", fare="fare_amount") -> DataFrame:
    """Library variant over raw text fields: adds trip_duration_minutes, average_speed_mph,
    revenue_per_minute, tip_percentage to every row (missing numbers count as 0; no cost per mile)."""
    c = F.col
    parsed = {"_ml_" + k: F.coalesce(parse_float(v), F.lit(0.0)) for k, v in
              {"distance": distance, "total": total, "tip": tip, "fare": fare}.items()}
    parsed["_ml_ms"] = duration_ms(parse_timestamp(pickup), parse_timestamp(dropoff))
    out = df.withColumns(parsed).withColumn("trip_duration_minutes", duration_minutes_from_ms(c("_ml_ms")))
    dur = c("trip_duration_minutes")
    return out.withColumns({
        "average_speed_mph": speed_mph(c("_ml_distance"), dur),
        "revenue_per_minute": money_per_minute(c("_ml_total"), dur),
        "tip_percentage": tip_percentage(c("_ml_tip"), c("_ml_fare")),
    }).drop(*parsed)
