"""The two summary tables (hourly_stats, zone_stats): from trips, and from mergeable partials of each load.

A partial holds the counts and exact sums of one load's trips by hour or zone; it has at most one row per hour and hour of day
(per zone), whatever the number of trips. A load writes its partial from its own trips only, a rerun replaces it, and the
tables are the merged partials of all loads: the same doubles as from all trips at once, since the sums are exact.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formats import iso_timestamp
from ..functions.rounding import merged_parts, parts_avg, parts_sum, sum_parts
from ..operators.joins import exists_in, join_zone_left
from ..session import switch_version
from .tables import Tables

HOUR_KEYS, HOUR_METRICS = ("hour_block_ts", "hour_of_day"), ("total", "tip", "tip_pct", "duration_min", "speed_mph", "money_per_min")
ZONE_KEYS, ZONE_METRICS = ("pickup_zone",), ("total", "tip_pct", "money_per_min")


def hourly_partials(trips: DataFrame) -> DataFrame:
    """Count and parts of the sums by hour."""
    return (trips.groupBy(F.date_trunc("hour", "pickup_time").alias("hour_block_ts"), "hour_of_day")
            .agg(F.count(F.lit(1)).alias("n"), *[sum_parts(m).alias(m) for m in HOUR_METRICS]))


def merged(keys: tuple[str, ...] | list[Column], metrics: tuple[str, ...], partials: DataFrame) -> DataFrame:
    return partials.groupBy(*keys).agg(F.sum("n").alias("n"), *[merged_parts(m).alias(m) for m in metrics])


def hourly_from(partials: DataFrame) -> DataFrame:
    """hourly_stats from rows with one partial per hour."""
    return partials.select(
        iso_timestamp("hour_block_ts").alias("hour_block"), "hour_of_day", F.col("n").alias("total_trips"), parts_avg("total").alias("avg_price"),
        parts_avg("tip").alias("avg_tip"), parts_avg("tip_pct").alias("avg_tip_pct"), parts_avg("duration_min").alias("avg_duration"),
        parts_avg("speed_mph").alias("avg_speed"), parts_sum("total").alias("revenue"), parts_avg("money_per_min").alias("earnings_per_min"))


def zones_from(t: Tables, partials: DataFrame) -> DataFrame:
    """zone_stats from rows with one partial per zone: every zone (also those without trips) with its trip metrics and
    whether a mappable shape exists. One row per zone meets the zone table."""
    per_zone = partials.select("pickup_zone", F.col("n").alias("_n"), parts_avg("total").alias("avg_fare"), parts_sum("total").alias("total_money"),
                               parts_avg("tip_pct").alias("avg_tip_pct"), parts_avg("money_per_min").alias("avg_money_min"))
    out = join_zone_left(t.zones, per_zone).select(
        F.col("z.id").alias("location_id"), F.col("z.borough").alias("borough"), F.col("z.zone_name").alias("zone_name"),
        F.coalesce(F.col("a._n"), F.lit(0)).cast("bigint").alias("trip_count"), "avg_fare", "total_money", "avg_tip_pct", "avg_money_min")
    if t.zone_shapes is None:
        return out.withColumn("has_shape", F.lit(False))
    return exists_in(out, t.zone_shapes, "location_id", "location_id", "has_shape", F.col("mappable"))


def hourly_stats(t: Tables) -> DataFrame:
    """From the stored partials of all loads where there are any, else from the trips."""
    stored = t.partials("hourly_partials")
    return hourly_from(hourly_partials(t.trips) if stored is None else merged(HOUR_KEYS, HOUR_METRICS, stored))


def zone_stats(t: Tables) -> DataFrame:
    """From the stored cube of all loads where there is one, else from the trips."""
    stored = t.partials("trip_cube")
    if stored is not None:
        return zones_from(t, merged(ZONE_KEYS, ZONE_METRICS, stored))
    return zones_from(t, t.trips.groupBy(*ZONE_KEYS).agg(F.count(F.lit(1)).alias("n"), *[sum_parts(m).alias(m) for m in ZONE_METRICS]))


def refresh_stats(t: Tables, root: str) -> None:
    """Both summary tables anew from the partials of all loads; no trips are read. Readers go over to the new version as a
    whole and keep what they had open."""
    spark = t.zones.sparkSession
    tables = {"hourly_stats": hourly_stats(t), "zone_stats": zone_stats(t)}
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(lambda name: switch_version(spark, root, name, tables[name]), tables))
