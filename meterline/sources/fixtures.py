"""Trip-shaped inputs derived from the given TPC-H-like tables by integer arithmetic only.

The recipe is fixed (see FIXTURES.md, family F3) so that any SQL engine evaluating it gets the same rows.
Every derived table is a narrow projection of its source table: no shuffle, and its size grows with it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import column_cache

# Fixed value: all derived pickup times count seconds from this instant (UTC).
EPOCH_2019 = int(dt.datetime(2019, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def money_text(cents: Column) -> Column:
    """Integer cents → text with two decimals, e.g. -705 → '-7.05' (same text as decimal(10,2) → string)."""
    a = F.abs(cents)
    return F.concat(F.when(cents < 0, F.lit("-")).otherwise(F.lit("")),
                    (a.cast("bigint") / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((a % 100).cast("string"), 2, "0"))


def _ts_text(seconds_since_2019: Column) -> Column:
    return F.date_format(F.timestamp_seconds(F.lit(EPOCH_2019) + seconds_since_2019), "yyyy-MM-dd HH:mm:ss")


def raw_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One all-string raw trip row per lineitem row, plus the lineage key ``row_num``."""
    return lineitem.select(*_raw_trip_columns())


@column_cache
def _raw_trip_columns():
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    q = F.col("l_quantity").cast("bigint")
    g = sk % 4
    fc = F.floor(F.col("l_extendedprice")).cast("bigint") / 10
    fc = fc.cast("bigint")  # integer division of a non-negative value
    dp = F.round(F.col("l_discount") * 100).cast("bigint")
    dur = (ok * 37 + ln * 601 + g * 1301) % 4500 - 60
    pu = (ok * 7919 + ln * 104729) % 2678400
    z = ok % 26
    z2 = (ok * 11 + ln) % 26
    fare_c = F.when(pk % 401 == 0, -fc).otherwise(fc)

    def s(c: Column) -> Column:
        return c.cast("string")

    return [
        ((((ok * 8 + ln) * 20000 + pk) * 1000 + sk) * 51 + q).alias("row_num"),
        F.when(sk % 50 == 0, F.lit("")).otherwise(s(1 + sk % 2)).alias("VendorID"),
        F.when(pk % 211 == 0, F.lit("not-a-date")).otherwise(_ts_text(pu)).alias("tpep_pickup_datetime"),
        _ts_text(pu + dur).alias("tpep_dropoff_datetime"),
        F.when(q == 50, F.lit("9")).when(q == 49, F.lit("0")).when(q == 48, F.lit(""))
         .otherwise(s(1 + q % 6)).alias("passenger_count"),
        F.when(pk % 311 == 0, F.lit("abc")).when(pk % 301 == 0, F.lit("0")).when(pk % 307 == 0, F.lit("150.25"))
         .otherwise(money_text(pk % 1500)).alias("trip_distance"),
        F.when(sk == 7, F.lit("99")).when(pk % 443 == 0, F.lit("")).otherwise(s(1 + ln % 6)).alias("RatecodeID"),
        F.when(pk % 17 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        F.when(z == 23, F.lit("264")).when(z == 24, F.lit("265")).when(z == 25, F.lit("999"))
         .otherwise(s(z + 1)).alias("PULocationID"),
        F.when(z2 == 23, F.lit("264")).when(z2 == 24, F.lit("265")).when(z2 == 25, F.lit("0"))
         .otherwise(s(z2 + 1)).alias("DOLocationID"),
        F.when(pk % 431 == 0, F.lit("0")).otherwise(s(1 + ln % 6)).alias("payment_type"),
        money_text(fare_c).alias("fare_amount"),
        F.lit("0.5").alias("extra"),
        F.lit("0.5").alias("mta_tax"),
        F.when(pk % 409 == 0, money_text(fc * 3)).when(pk % 419 == 0, money_text(F.lit(-100)))
         .otherwise(money_text((fc * dp / 25).cast("bigint"))).alias("tip_amount"),
        F.when(pk % 23 == 0, F.lit("5.76")).otherwise(F.lit("0")).alias("tolls_amount"),
        F.lit("0.3").alias("improvement_surcharge"),
        money_text((ok * 131 + ln * 977 + g * 3571) % 9000 - 150).alias("total_amount"),
        F.when(pk % 3 == 0, F.lit("")).otherwise(F.lit("2.5")).alias("congestion_surcharge"),
    ]


def zones_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup rows (id, borough, zone_name, service_zone) from nation ⋈ region (25 rows)."""
    nk = F.col("n_nationkey")
    from ..operators.joins import sized_broadcast
    region = sized_broadcast(region)
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return joined.select(
        F.when(nk == 23, 264).when(nk == 24, 265).otherwise(nk + 1).cast("int").alias("id"),
        F.when(nk == 23, F.lit("Unknown")).when(nk == 24, F.lit("N/A")).otherwise(F.col("r_name")).alias("borough"),
        F.col("n_name").alias("zone_name"),
        F.when(nk.isin(23, 24), F.lit("N/A")).otherwise(F.col("r_name")).alias("service_zone"),
    )


def zone_polygons_from_part(part: DataFrame) -> DataFrame:
    """Zone-polygon features in the raw GeoJSON-row shape of ``scan_zone_polygons``, one per ``part`` row.

    A square ring of half-side ``p_size*50+50`` feet on a grid around the projection origin; every third
    row is a MultiPolygon with a second small square. ``LocationID`` is missing on every seventh row (then
    ``location_id`` or ``OBJECTID`` is used). Integer arithmetic only.
    """
    pk = F.col("p_partkey")
    cx = F.lit(900000) + (pk % 200) * 1000
    cy = F.lit(120000) + (pk / 200).cast("bigint") % 200 * 1000
    half = F.col("p_size").cast("bigint") * 50 + 50

    def ring(x0: Column, y0: Column, h: Column) -> Column:
        pts = [(x0 - h, y0 - h), (x0 + h, y0 - h), (x0 + h, y0 + h), (x0 - h, y0 + h), (x0 - h, y0 - h)]
        return F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in pts])

    outer = ring(cx, cy, half)
    small = ring(cx + half * 3, cy, F.lit(40))
    is_multi = pk % 3 == 0
    coords = F.when(is_multi, F.to_json(F.array(F.array(outer), F.array(small)))).otherwise(F.to_json(F.array(outer)))
    no_loc = pk % 7 == 0
    props = F.struct(
        F.when(no_loc, F.lit(None)).otherwise(pk).cast("int").alias("LocationID"),
        F.when(no_loc & (pk % 2 == 0), pk + 100000).cast("int").alias("location_id"),
        pk.cast("int").alias("OBJECTID"),
        (half * half * 4).cast("double").alias("Shape_Area"),
        F.when(pk % 11 == 0, F.lit(None)).otherwise(half * 8).cast("double").alias("Shape_Leng"),
    )
    geometry = F.struct(F.when(is_multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("type"),
                        coords.alias("coordinates"))
    return part.select(F.lit("Feature").alias("type"), props.alias("properties"), geometry.alias("geometry"))
