"""Tip queries: by borough, by hour, by payment type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import parts_avg, parts_sum
from ..operators.aggs import ratio_pct
from ..operators.joins import lookup_payment_label
from .profitability import known_borough
from .rollups import add_percentiles, rollup
from .tables import Tables


def borough_groups(t: Tables) -> DataFrame:
    """Tips by borough without the median."""
    rows = rollup(t, {"borough": F.col("z.borough")}, ("tip_pct", "tip", "total"), present="tip_pct", known=known_borough())
    return rows.select("borough", F.col("n").alias("trip_count"), parts_avg("tip_pct").alias("avg_tip_percentage"), parts_avg("tip").alias("avg_tip_amount"),
                       parts_sum("tip").alias("total_tips"), parts_sum("total").alias("total_revenue"))


def hour_groups(t: Tables) -> DataFrame:
    rows = rollup(t, {"hour_of_day": F.col("hour_of_day")}, ("tip_pct", "tip"), present="tip_pct")
    return rows.select("hour_of_day", F.col("n").alias("trip_count"), parts_avg("tip_pct").alias("avg_tip_percentage"), parts_avg("tip").alias("avg_tip_amount"),
                       parts_sum("tip").alias("total_tips"))


def payment_groups(t: Tables) -> DataFrame:
    rows = rollup(t, {"payment_type": F.col("payment_type")}, ("tip_pct", "tip"), present="tip_pct",
                  extremes={"min_tip_percentage": "min_tip_pct", "max_tip_percentage": "max_tip_pct"})
    return rows.where(F.col("payment_type").isNotNull()).select(
        "payment_type", F.col("n").alias("trip_count"), parts_avg("tip_pct").alias("avg_tip_percentage"), parts_avg("tip").alias("avg_tip_amount"),
        parts_sum("tip").alias("total_tips"), "min_tip_percentage", "max_tip_percentage")


def tips_by_borough(t: Tables) -> DataFrame:
    found = add_percentiles(t, borough_groups(t), "borough", "pickup_zone", {"median_tip_percentage": ("tip_pct", 0.5)}, "tip_pct", known_borough())
    return (found.withColumn("tips_as_pct_of_revenue", ratio_pct(F.col("total_tips"), F.col("total_revenue")))
            .select("borough", "trip_count", "avg_tip_percentage", "avg_tip_amount", "total_tips", "total_revenue",
                    "tips_as_pct_of_revenue", "median_tip_percentage")
            .orderBy(F.desc_nulls_first("avg_tip_percentage"), F.asc("borough")))


def tips_by_hour(t: Tables) -> DataFrame:
    found = add_percentiles(t, hour_groups(t), "hour_of_day", "hour_of_day", {"median_tip_percentage": ("tip_pct", 0.5)}, "tip_pct")
    return found.orderBy(F.asc_nulls_last("hour_of_day"))


def payment_comparison(t: Tables) -> DataFrame:
    wanted = {"median_tip_percentage": ("tip_pct", 0.5), "p90_tip_percentage": ("tip_pct", 0.9)}
    return (add_percentiles(t, payment_groups(t), "payment_type", "payment_type", wanted, "tip_pct")
            .withColumn("payment_label", lookup_payment_label(F.col("payment_type")))
            .orderBy(F.asc_nulls_last("payment_type")))
