"""Dashboard roll-ups computed on top of the named queries (all inputs are small, already-aggregated
frames: at most 100 zones, a handful of boroughs, 24 hours, 6 payment types, 13 flag codes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BOROUGH_ORDER, FLAG_META
from ..functions.formats import default_dash, fixed_text, fmt_hr, fmt_num, fmt_pct, fmt_rpm, fmt_usd, label_spaces
from ..functions.rounding import merged_parts, parts_avg, to_fixed
from ..operators.errorlog import json_extract_num
from ..operators.joins import cross_scalar, flag_meta_table, lookup_flag_note, sized_broadcast
from ..operators.sorting import rank_column
from . import anomalies, overview, profitability, tips
from .profitability import known_borough
from .rollups import rollup
from .tables import Tables


def borough_order_table(spark: SparkSession, order: Sequence[str] = BOROUGH_ORDER) -> DataFrame:
    return spark.createDataFrame([(b, i) for i, b in enumerate(order)], "borough string, display_order int")


def borough_order_from_zones(zones: DataFrame) -> DataFrame:
    """A display order for data whose boroughs are not the fixed dashboard list: alphabetical."""
    names = zones.where(F.col("borough").isNotNull()).select("borough").distinct()
    return names.select("borough", (F.dense_rank().over(Window.orderBy("borough")) - 1).cast("int")
                        .alias("display_order"))


def borough_volume(t: Tables, order: DataFrame | None = None, top: int = 100) -> DataFrame:
    """Trip counts by borough over the top-``top`` pickup zones, only boroughs of the display order."""
    zones = overview.top_zones(t, top)
    order = order if order is not None else borough_order_table(t.trips.sparkSession)
    per = (zones.where(F.col("borough").isNotNull()).groupBy("borough")
           .agg(F.sum("trip_count").cast("bigint").alias("trips")))
    return (per.join(sized_broadcast(order), "borough", "inner").where(F.col("trips") > 0)
            .orderBy("display_order").select("borough", "trips", "display_order"))


def profit_ranking(t: Tables, limit: int = 20) -> DataFrame:
    top = profitability.top_profitable_zones(t, limit)
    table = top.select(
        "location_id",
        default_dash("zone_name").alias("zone_name"),
        default_dash("borough").alias("borough"),
        F.coalesce(F.col("avg_revenue_per_minute"), F.lit(0.0)).alias("rev_min"),
        F.coalesce(F.col("avg_total_amount"), F.lit(0.0)).alias("avg_fare"),
        F.coalesce(F.col("avg_tip_percentage"), F.lit(0.0)).alias("avg_tip"),
        F.coalesce(F.col("trip_count"), F.lit(0)).cast("bigint").alias("trips"))
    return rank_column(table, [F.desc_nulls_first("rev_min"), F.asc("location_id")])


def _card_cash(t: Tables) -> DataFrame:
    return tips.payment_groups(t).agg(
        F.max(F.when(F.col("payment_type") == 1, F.col("avg_tip_percentage"))).alias("card_avg"),
        F.max(F.when(F.col("payment_type") == 2, F.col("avg_tip_percentage"))).alias("cash_avg"),
        F.count_if(F.col("payment_type") == 1).alias("_has_card"),
        F.count_if(F.col("payment_type") == 2).alias("_has_cash"))


def tip_payment_split(t: Tables) -> DataFrame:
    """Per borough: its average tip % scaled by the card (resp. cash) average over their mean (or 1)."""
    # one pass over the trips: its groups by zone and payment type count once for their payment type and once for their borough
    parts = rollup(t, {"zone": F.col("pickup_zone"), "payment_type": F.col("payment_type")}, ("tip_pct",), present="tip_pct")
    none = F.lit(None).cast("int")
    sides = F.inline(F.array(F.struct(F.col("zone").alias("zone_ref"), none.alias("paid_by")), F.struct(none.alias("zone_ref"), F.col("payment_type").alias("paid_by"))))
    sided = parts.select("tip_pct", sides).join(sized_broadcast(t.zones).alias("z"), F.col("zone_ref") == F.col("z.id"), "left")
    averages = (sided.groupBy(F.when(known_borough(), F.col("z.borough")).alias("borough"), "paid_by").agg(merged_parts("tip_pct").alias("tip_pct"))
                .select("borough", "paid_by", parts_avg("tip_pct").alias("avg_tip_percentage")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # of a row per borough and payment type
    average = lambda paid_by: F.coalesce(F.max(F.when(F.col("paid_by") == paid_by, F.col("avg_tip_percentage"))).over(everything), F.lit(0.0))
    split = averages.withColumns({"card_avg": average(1), "cash_avg": average(2)}).where(F.col("borough").isNotNull())
    mid = (F.col("card_avg") + F.col("cash_avg")) / F.lit(2)
    split = split.withColumn("mid", F.when(mid == 0, F.lit(1.0)).otherwise(mid))
    return split.select(
        "borough",
        to_fixed(F.col("avg_tip_percentage") * F.col("card_avg") / F.col("mid"), 2).alias("card"),
        to_fixed(F.col("avg_tip_percentage") * F.col("cash_avg") / F.col("mid"), 2).alias("cash"))


def tip_insight(t: Tables) -> DataFrame:
    """Card vs cash averages, premium (1 dp), top borough and peak tip hour. On ties the later row wins
    (later in the API order), hence the descending tie-breaks. Empty unless both card and cash exist."""
    cc = _card_cash(t).where((F.col("_has_card") > 0) & (F.col("_has_cash") > 0))
    top_b = (tips.borough_groups(t).orderBy(F.desc_nulls_last("avg_tip_percentage"), F.desc("borough")).limit(1)
             .select(F.col("borough").alias("top_borough"), F.col("avg_tip_percentage").alias("top_borough_tip_pct")))
    peak = (tips.hour_groups(t).orderBy(F.desc_nulls_last("avg_tip_percentage"), F.desc("hour_of_day")).limit(1)
            .select(F.col("hour_of_day").alias("peak_hour"), fmt_hr(F.col("hour_of_day")).alias("peak_hour_label")))
    out = cross_scalar(cc, top_b, peak)   # one-row frames; an empty top frame gives NULL fields
    return out.select("card_avg", "cash_avg",
                      to_fixed(F.col("card_avg") - F.col("cash_avg"), 1).alias("premium_pp"),
                      "top_borough", "top_borough_tip_pct", "peak_hour", "peak_hour_label")


def flag_table(t: Tables, limit: int = 50) -> DataFrame:
    page, _ = anomalies.anomaly_list(t, limit, 0)
    detail_fare = json_extract_num(F.col("details"), "fare")
    fare = F.coalesce(F.col("fare"), detail_fare)
    return page.select("row_num", "err_type",
                       F.when(fare.isNotNull(), fmt_usd(fare)).otherwise(F.lit("—")).alias("fare_display"),
                       lookup_flag_note(F.col("err_type")).alias("note"))


def top_flag(t: Tables) -> DataFrame:
    return anomalies.by_type(t).limit(1).select(
        F.col("err_type").alias("top_flag"), label_spaces("err_type").alias("top_flag_label"))


def flag_legend(t: Tables) -> DataFrame:
    """Flag codes present in the counts, with label, description, action and count, grouped
    retained-then-excluded (codes without metadata are left out)."""
    meta = flag_meta_table(t.trips.sparkSession)
    counts = anomalies.by_type(t)
    joined = counts.join(F.broadcast(meta), "err_type", "inner")   # fixed 13-row table
    return (joined.select("action", "err_type", "label", "description", F.col("count").cast("bigint").alias("count"))
            .orderBy(F.when(F.col("action") == "retained", 0).otherwise(1), F.desc("count"), F.asc("err_type")))


FLAG_CODES = tuple(FLAG_META)


def top_zones_table(t: Tables, rows: int = 10) -> DataFrame:
    """The first ``rows`` of the top-100 pickup zones, ranked, with display text ('—' for missing values)."""
    top = overview.top_zones(t, 100)
    ranked = rank_column(top, [F.desc_nulls_first("trip_count"), F.asc("location_id")]).where(F.col("rank") <= rows)
    dash = F.lit("—")
    return ranked.select(
        "rank", "location_id",
        default_dash("zone_name").alias("zone_name"),
        default_dash("borough").alias("borough"),
        fmt_num(F.col("trip_count")).alias("trips_text"),
        F.when(F.coalesce(F.col("avg_fare"), F.lit(0.0)) != 0, fmt_usd(F.col("avg_fare"))).otherwise(dash).alias("fare_text"),
        F.when(F.coalesce(F.col("avg_tip_percentage"), F.lit(0.0)) != 0, fmt_pct(F.col("avg_tip_percentage")))
         .otherwise(dash).alias("tip_text"))


def kpi_cards(t: Tables) -> DataFrame:
    """Overview cards: trips, average fare, revenue per minute, average speed (1 dp + ' mph')."""
    k = overview.overview_kpis(t)
    return k.select(fmt_num(F.col("total_trips")).alias("total_trips_text"), fmt_usd(F.col("avg_fare")).alias("avg_fare_text"),
                    fmt_rpm(F.col("avg_revenue_per_minute")).alias("rev_per_min_text"),
                    F.concat(fixed_text(F.col("avg_speed_mph"), 1), F.lit(" mph")).alias("avg_speed_text"))


def anomaly_cards(t: Tables) -> DataFrame:
    """Anomaly cards: flagged trips, share of all trips, most common flag with underscores as spaces."""
    s = anomalies.summary(t)
    top = top_flag(t)
    return cross_scalar(s, top).select(fmt_num(F.col("unique_flagged_rows")).alias("flagged_text"),
                                   fmt_pct(F.col("flag_rate_percent")).alias("rate_text"),
                                   F.col("top_flag_label"))
