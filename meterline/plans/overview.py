"""Overview queries: KPIs, trips over time, top pickup zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT
from ..functions.formats import iso_timestamp
from ..functions.rounding import merged_parts, parts_avg, parts_sum, sum_parts, to_fixed
from ..operators.aggs import distinct_from_bitmaps
from ..operators.joins import cross_scalar, known_zone
from ..operators.sorting import clamp_limit, result_with_meta, top_n
from .rollups import METRICS, bitmaps, flags, rollup
from .stats import merged
from .tables import Tables


def overview_kpis(t: Tables) -> DataFrame:
    if t.partials("trip_cube") is None:  # one pass over the trips for sums and zones: by pair of zones, of which there are few
        pairs = t.trips.groupBy("pickup_zone", "dropoff_zone").agg(
            F.count(F.lit(1)).alias("n"), *[sum_parts(m).alias(m) for m in METRICS], F.min("pickup_time").alias("first"), F.max("pickup_time").alias("last"))
        trips = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[merged_parts(m).alias(m) for m in METRICS], F.min("first").alias("first"), F.max("last").alias("last"),
                          *[F.count_distinct(z).alias(f"unique_{z}s") for z in ("pickup_zone", "dropoff_zone")])
    else:
        trips = cross_scalar(rollup(t, {}, METRICS, extremes={"first": "first_pickup", "last": "last_pickup"}), distinct_from_bitmaps(bitmaps(t), ["unique_pickup_zones", "unique_dropoff_zones"]))
    kpis = trips.select(
        F.col("n").alias("total_trips"),
        to_fixed(parts_sum("total"), 2).alias("total_revenue"),
        to_fixed(parts_avg("total"), 2).alias("avg_fare"),
        to_fixed(parts_avg("duration_min"), 2).alias("avg_duration_minutes"),
        to_fixed(parts_avg("speed_mph"), 2).alias("avg_speed_mph"),
        to_fixed(parts_avg("tip_pct"), 2).alias("avg_tip_percentage"),
        to_fixed(parts_sum("tip"), 2).alias("total_tips"),
        to_fixed(parts_avg("money_per_min"), 4).alias("avg_revenue_per_minute"),
        iso_timestamp(F.col("first")).alias("earliest_trip"),
        iso_timestamp(F.col("last")).alias("latest_trip"),
        "unique_pickup_zones", "unique_dropoff_zones",
    )
    flagged = flags(t).agg(F.coalesce(F.sum(F.when(F.col("err_type").isNull(), F.col("count"))), F.lit(0)).alias("flag_rows"))
    return cross_scalar(kpis, flagged)


def time_unit(granularity) -> str:
    """hour where asked for, else day."""
    return "hour" if granularity == "hour" else "day"


def trips_over_time(t: Tables, granularity: str = "day") -> DataFrame:
    stored = t.partials("hourly_partials")
    period = F.date_trunc(time_unit(granularity), "pickup_time" if stored is None else "hour_block_ts").alias("_period")
    if stored is None:
        rows = t.trips.groupBy(period).agg(F.count(F.lit(1)).alias("n"), sum_parts("total").alias("total"), sum_parts("duration_min").alias("duration_min"))
    else:
        rows = merged([period], ("total", "duration_min"), stored)
    return (rows.orderBy(F.asc_nulls_last("_period"))
            .select(iso_timestamp("_period").alias("period"), F.col("n").alias("trip_count"), parts_sum("total").alias("total_revenue"),
                    parts_avg("total").alias("avg_fare"), parts_avg("duration_min").alias("avg_duration_minutes")))


def top_zones(t: Tables, limit=TOP_ZONES_DEFAULT_LIMIT) -> DataFrame:
    n = clamp_limit(limit, TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT)
    keys = {"location_id": F.col("z.id"), "borough": F.col("z.borough"), "zone_name": F.col("z.zone_name")}
    grouped = rollup(t, keys, ("total", "tip_pct"), known=known_zone()).select(
        *keys, F.col("n").alias("trip_count"), parts_sum("total").alias("total_revenue"), parts_avg("total").alias("avg_fare"), parts_avg("tip_pct").alias("avg_tip_percentage"))
    return top_n(grouped, [F.desc_nulls_first("trip_count"), F.asc("location_id")], n)


def trips_over_time_meta(t: Tables, granularity: str = "day") -> tuple[DataFrame, DataFrame]:
    """(rows, meta) of the endpoint: the granularity that was taken and the number of periods."""
    return result_with_meta(trips_over_time(t, granularity), granularity=time_unit(granularity))


def top_zones_meta(t: Tables, limit=TOP_ZONES_DEFAULT_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(rows, meta) of the endpoint: the limit that was taken and the number of zones returned."""
    return result_with_meta(top_zones(t, limit), limit=clamp_limit(limit, TOP_ZONES_DEFAULT_LIMIT, TOP_ZONES_MAX_LIMIT))
