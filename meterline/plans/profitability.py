"""Profitability queries: top zones by revenue per minute, by borough (with medians), by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MIN_ZONE_TRIPS, TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT
from ..functions.rounding import parts_avg, parts_sum
from ..operators.joins import known_zone
from ..operators.sorting import clamp_limit, top_n
from .rollups import add_percentiles, rollup
from .tables import Tables


def known_borough() -> F.Column:
    return F.col("z.borough").isNotNull() & known_zone(check_zone_name=False)


def top_profitable_zones(t: Tables, limit=TOP_ZONES_DEFAULT_LIMIT, min_trips: int = MIN_ZONE_TRIPS) -> DataFrame:
    n = clamp_limit(limit, TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT)
    keys = {"location_id": F.col("z.id"), "borough": F.col("z.borough"), "zone_name": F.col("z.zone_name"), "service_zone": F.col("z.service_zone")}
    rows = rollup(t, keys, ("money_per_min", "total", "duration_min", "speed_mph", "tip_pct"), present="money_per_min", known=known_zone())
    grouped = rows.where(F.col("n") >= min_trips).select(
        *keys, F.col("n").alias("trip_count"), parts_avg("money_per_min").alias("avg_revenue_per_minute"), parts_avg("total").alias("avg_total_amount"),
        parts_sum("total").alias("total_revenue"), parts_avg("duration_min").alias("avg_duration_minutes"), parts_avg("speed_mph").alias("avg_speed_mph"),
        parts_avg("tip_pct").alias("avg_tip_percentage"))
    return top_n(grouped, [F.desc_nulls_first("avg_revenue_per_minute"), F.asc("location_id")], n)


def by_borough(t: Tables) -> DataFrame:
    rows = rollup(t, {"borough": F.col("z.borough")}, ("total", "money_per_min", "duration_min", "speed_mph", "tip_pct"), known=known_borough())
    grouped = rows.select("borough", F.col("n").alias("trip_count"), parts_sum("total").alias("total_revenue"), parts_avg("total").alias("avg_fare"),
                          parts_avg("money_per_min").alias("avg_revenue_per_minute"), parts_avg("duration_min").alias("avg_duration_minutes"),
                          parts_avg("speed_mph").alias("avg_speed_mph"), parts_avg("tip_pct").alias("avg_tip_percentage"))
    medians = {"median_fare": ("total", 0.5), "median_revenue_per_minute": ("money_per_min", 0.5)}
    return (add_percentiles(t, grouped, "borough", "pickup_zone", medians, known=known_borough())
            .orderBy(F.desc_nulls_first("total_revenue"), F.asc("borough")))


def by_hour(t: Tables) -> DataFrame:
    rows = rollup(t, {"hour_of_day": F.col("hour_of_day")}, ("money_per_min", "total", "duration_min", "speed_mph"), present="money_per_min")
    return rows.select("hour_of_day", F.col("n").alias("trip_count"), parts_avg("money_per_min").alias("avg_revenue_per_minute"), parts_avg("total").alias("avg_fare"),
                       parts_sum("total").alias("total_revenue"), parts_avg("duration_min").alias("avg_duration_minutes"),
                       parts_avg("speed_mph").alias("avg_speed_mph")).orderBy(F.asc_nulls_last("hour_of_day"))
