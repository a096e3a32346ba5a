"""Keep-first de-duplication on the trip key.

``row_number() over (partition by key order by row_num) = 1``: Catalyst plans this as a WindowGroupLimit
that also runs *before* the shuffle, so a key repeated millions of times is cut to one row per map task
before it is exchanged. NULL key parts compare equal, like the ``''`` the reference's text key uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import js_number_text

TRIP_KEY = ("vendor", "pickup_time", "dropoff_time", "pickup_zone", "dropoff_zone", "total")
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def trip_key_text(vendor="vendor", pickup="pickup_time", dropoff="dropoff_time", pu="pickup_zone",
                  do="dropoff_zone", total="total") -> Column:
    """The key as one text value: parts joined by '|', NULL → ''."""
    c = F.col
    parts = [c(vendor).cast("string"), F.date_format(c(pickup), ISO_FORMAT), F.date_format(c(dropoff), ISO_FORMAT),
             c(pu).cast("string"), c(do).cast("string"), F.when(c(total).isNotNull(), js_number_text(total))]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])


def dedup_keep_first(df: DataFrame, keys: Sequence[str] = TRIP_KEY, order_col: str = "row_num") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
    return df.withColumn("_ml_rn", F.row_number().over(w)).where(F.col("_ml_rn") == 1).drop("_ml_rn")


def dedup_with_count(df: DataFrame, keys: Sequence[str] = TRIP_KEY, order_col: str = "row_num"):
    """(unique rows, one-row DataFrame with ``unique_count`` and ``duplicate_count``)."""
    unique = dedup_keep_first(df, keys, order_col)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    kept = unique.agg(F.count(F.lit(1)).alias("unique_count"))
    counts = kept.select("unique_count", (total.scalar() - F.col("unique_count")).alias("duplicate_count"))
    return unique, counts
