"""Mergeable partials of a load's trips and flags, and the groups that the named queries read from them.

``trip_cube`` has one row per pickup zone, hour of day, payment type and presence of the two nullable ratios: count, exact sum
parts, extremes. ``value_counts`` has the distinct values of the metrics with percentiles by zone, hour or payment type;
``zone_bitmaps`` the zone ids; ``flag_counts`` the flags by type and the number of rows that have any. The size of each is
bounded by the codes and values that occur, not by the trips. Each load writes its own, from its own rows, and they add
up over loads: the doubles are those of all trips at once, since every sum is kept exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HARD_FLAG_TYPES
from ..functions.rounding import merged_parts, sum_parts
from ..operators.aggs import bitmap_partials, join_percentiles, value_counts, with_percentiles
from ..operators.errorlog import explode_flags, soft_only
from ..operators.joins import join_zone_inner
from .tables import Tables

METRICS = ("total", "tip", "tip_pct", "duration_min", "speed_mph", "money_per_min")
#: Columns whose NULL rows some queries leave out.
OPTIONAL = ("tip_pct", "money_per_min")
CUBE_KEYS = ("pickup_zone", "hour_of_day", "payment_type")
#: Percentiles are asked for these: dimension and its key column, metric.
COUNTED = (("pickup_zone", "tip_pct"), ("hour_of_day", "tip_pct"), ("payment_type", "tip_pct"), ("pickup_zone", "total"), ("pickup_zone", "money_per_min"))


def _has(metric: str) -> str:
    return f"has_{metric}"


def trip_cube(trips: DataFrame) -> DataFrame:
    has = [F.col(m).isNotNull().alias(_has(m)) for m in OPTIONAL]
    return trips.groupBy(*CUBE_KEYS, *has).agg(
        F.count(F.lit(1)).alias("n"), *[sum_parts(m).alias(m) for m in METRICS], F.min("tip_pct").alias("min_tip_pct"), F.max("tip_pct").alias("max_tip_pct"),
        F.min("pickup_time").alias("first_pickup"), F.max("pickup_time").alias("last_pickup"))


def trip_value_counts(trips: DataFrame) -> DataFrame:
    """dimension, key, metric, v, n. Values of trips without a payment type or hour count under a NULL key."""
    each = F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("int").alias("key"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for d, m in COUNTED]))
    return trips.select(each).where(F.col("v").isNotNull()).groupBy("dimension", "key", "metric", "v").agg(F.count(F.lit(1)).alias("n"))


def zone_bitmaps(trips: DataFrame) -> DataFrame:
    # zone pairs first: a bitmap is updated for each pair, not for each trip
    pairs = trips.groupBy("pickup_zone", "dropoff_zone").agg(F.count(F.lit(1)).alias("n"))
    return bitmap_partials(pairs, {"unique_pickup_zones": F.col("pickup_zone"), "unique_dropoff_zones": F.col("dropoff_zone")})


def flag_counts(errors: DataFrame) -> DataFrame:
    """err_type and count of the flags that the API shows; the row without a type has the number of flagged rows. Rows are told
    apart by load and number, as every load numbers its rows from 1."""
    soft = soft_only(errors)
    row = [c for c in ("load_id", "row_num") if c in errors.columns]
    by_type = soft.groupBy("err_type").agg(F.count(F.lit(1)).alias("count"))
    rows = soft.select(*row).distinct().agg(F.lit(None).cast("string").alias("err_type"), F.count(F.lit(1)).alias("count"))
    return by_type.unionByName(rows)


#: Partial tables of a load: name and how they come from its trips.
TRIP_PARTIALS = {"trip_cube": trip_cube, "value_counts": trip_value_counts, "zone_bitmaps": zone_bitmaps}


def bitmaps(t: Tables) -> DataFrame:
    stored = t.partials("zone_bitmaps")
    return zone_bitmaps(t.trips) if stored is None else stored


def load_tallies(t: Tables) -> DataFrame | None:
    """what, err_type, count: the records of each shown flag ('flag'), the rows that have any ('rows', also if there are none) and the
    trips ('trips') of a load that isn't stored. Raw rows and kept trips are gone through once each, without the log being built. None for a store."""
    if t.loaded is None:
        return None

    def mark(what: str, n: int, err_type: Column | None = None, row: Column | None = None) -> Column:
        return F.struct(F.lit(what).alias("what"), (F.lit(None).cast("string") if err_type is None else err_type).alias("err_type"),
                        (F.lit(None).cast("bigint") if row is None else row).alias("row"), F.lit(n).cast("bigint").alias("n"))

    def shown(records: int) -> list[Column]:
        soft = F.col("flag.err_type").isNotNull() & ~F.col("flag.err_type").isin(*HARD_FLAG_TYPES)
        return [F.when(soft, mark("flag", records, F.col("flag.err_type"))), F.when(soft, mark("rows", 1, row=F.col("row_num").cast("bigint")))]

    trip = F.when((F.coalesce(F.col("pos"), F.lit(0)) == 0) & ~F.col("orphan"), mark("trips", 1))
    marks = [explode_flags(t.loaded.norm, "raw_flags").select(F.inline(F.array(*shown(1)))),
             # a post flag of a trip is two records of the log
             t.loaded.kept.select("row_num", "orphan", F.posexplode_outer("post_flags").alias("pos", "flag")).select(F.inline(F.array(*shown(2), trip))),
             t.zones.sparkSession.range(1).select(F.inline(F.array(mark("rows", 0))))]
    marks = marks[0].unionByName(marks[1]).unionByName(marks[2]).where(F.col("what").isNotNull())
    each = marks.groupBy("what", "err_type", "row").agg(F.sum("n").alias("n"))
    n = F.when(F.col("what") == "rows", (F.col("n") > 0).cast("bigint")).otherwise(F.col("n"))
    return each.groupBy("what", "err_type").agg(F.sum(n).alias("count"))


def flags(t: Tables) -> DataFrame:
    """``flag_counts`` over all loads."""
    stored = t.partials("flag_counts")
    if stored is not None:
        return stored.groupBy("err_type").agg(F.sum("count").alias("count"))
    made = load_tallies(t)
    return flag_counts(t.error_log) if made is None else made.where(F.col("what") != "trips").select("err_type", "count")


def rollup(t: Tables, keys: dict[str, Column], metrics: tuple[str, ...], present: str | None = None, known: Column | None = None,
           extremes: dict[str, str] | None = None) -> DataFrame:
    """One row per group: the keys, ``n`` and the sum parts of ``metrics``, over trips whose ``present`` metric isn't NULL. With ``known``,
    trips are joined to their pickup zones (alias z) and filtered by it. ``extremes`` are min_tip_pct, max_tip_pct,
    first_pickup or last_pickup by result name. From the stored cube where there is one, else from the trips."""
    cube = t.partials("trip_cube")
    rows = t.trips if cube is None else cube
    if present is not None:
        rows = rows.where(F.col(present).isNotNull() if cube is None else F.col(_has(present)))
    if known is not None:
        rows = join_zone_inner(rows, t.zones).where(known)
    source = {"min_tip_pct": "tip_pct", "max_tip_pct": "tip_pct", "first_pickup": "pickup_time", "last_pickup": "pickup_time"}
    ends = [(F.min if what.startswith(("min", "first")) else F.max)(what if cube is not None else source[what]).alias(name) for name, what in (extremes or {}).items()]
    n, parts = (F.count(F.lit(1)), sum_parts) if cube is None else (F.coalesce(F.sum("n"), F.lit(0)), merged_parts)
    return rows.groupBy(*[k.alias(name) for name, k in keys.items()]).agg(n.alias("n"), *[parts(m).alias(m) for m in metrics], *ends)


def add_percentiles(t: Tables, grouped: DataFrame, key: str, dimension: str, wanted: dict[str, tuple[str, float]], present: str | None = None,
                    known: Column | None = None) -> DataFrame:
    """``grouped`` with percentiles for each name: (metric, p), grouped by ``key``: the ``dimension`` column itself, or with ``known``
    the borough of the pickup zone. From the stored value counts where there are any, else from the trips."""
    counts = t.partials("value_counts")
    if counts is None:
        rows = t.trips if present is None else t.trips.where(F.col(present).isNotNull())
        column = F.col(dimension)
        if known is not None:
            rows, column = join_zone_inner(rows, t.zones).where(known), F.col("z.borough")
        return with_percentiles(grouped, rows, {key: column}, {name: (F.col(m), p) for name, (m, p) in wanted.items()})
    names = sorted({m for m, _ in wanted.values()})
    number = F.coalesce(*[F.when(F.col("metric") == m, F.lit(i)) for i, m in enumerate(names)])
    counts = counts.where((F.col("dimension") == dimension) & F.col("metric").isin(*names)).withColumn("i", number).withColumnRenamed("key", dimension)
    column = F.col(dimension)
    if known is not None:
        counts, column = join_zone_inner(counts, t.zones, dimension).where(known), F.col("z.borough")
    counts = counts.select(column.alias(key), "i", "v", "n")
    return join_percentiles(grouped, counts, [key], {name: (names.index(m), p) for name, (m, p) in wanted.items()})
