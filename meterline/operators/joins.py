"""Joins against the zone dimension and small lookups.

Broadcasting is always behind a size check (``sized_broadcast``): a side is broadcast only when it is
estimated to hold at most ``max_bytes`` bytes; otherwise the plain DataFrame is returned and Catalyst plans a
shuffle join (with AQE skew handling) instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EXCLUDED_ZONE_IDS, EXCLUDED_ZONE_NAMES, FLAG_META, FLAG_NOTES, PAYMENT_LABEL_DEFAULT, PAYMENT_LABELS

BROADCAST_MAX_BYTES = 64 << 20


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if the optimizer's size estimate of ``df`` is at most ``max_bytes``, else ``df`` unchanged. The
    estimate comes from the plan as it is now; no job runs and nothing is remembered."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(estimate)) <= max_bytes else df


def known_zone(zones_alias: str = "z", check_zone_name: bool = True) -> Column:
    z = lambda c: F.col(f"{zones_alias}.{c}")
    cond = ~z("id").isin(*EXCLUDED_ZONE_IDS) & ~z("borough").isin(*EXCLUDED_ZONE_NAMES)
    if check_zone_name:
        cond = cond & ~z("zone_name").isin(*EXCLUDED_ZONE_NAMES)
    return cond


def join_zone_inner(trips: DataFrame, zones: DataFrame, on: str = "pickup_zone") -> DataFrame:
    """trips ⋈ zones on ``trips.<on> = zones.id``; zones broadcast (size-checked). Aliases: t, z."""
    t, z = trips.alias("t"), sized_broadcast(zones).alias("z")
    return t.join(z, F.col(f"t.{on}") == F.col("z.id"), "inner")


def join_zone_left(zones: DataFrame, per_zone: DataFrame, key: str = "pickup_zone") -> DataFrame:
    """zones LEFT JOIN (already aggregated per-zone rows): zones without trips stay. Aggregating first
    means only one row per zone is joined instead of every trip."""
    return zones.alias("z").join(per_zone.alias("a"), F.col("z.id") == F.col(f"a.{key}"), "left")


def exists_in(df: DataFrame, other: DataFrame, left_key: str, right_key: str, flag: str,
              condition: Column | None = None) -> DataFrame:
    """Adds boolean ``flag`` = EXISTS(row of ``other`` with matching key [and condition])."""
    keys = other.where(condition) if condition is not None else other
    keys = keys.select(F.col(right_key).alias("_ml_k")).distinct().withColumn("_ml_hit", F.lit(True))
    out = df.join(keys, F.col(left_key) == F.col("_ml_k"), "left")
    return out.withColumn(flag, F.coalesce(F.col("_ml_hit"), F.lit(False))).drop("_ml_k", "_ml_hit")


def mark_orphans(trips: DataFrame, zones: DataFrame, columns=("pickup_zone", "dropoff_zone"),
                 flag: str = "orphan") -> DataFrame:
    """Adds boolean ``flag``: some checked column holds a non-NULL id missing from ``zones``.
    One size-checked broadcast left join per checked column; no shuffle of the trips."""
    ids = sized_broadcast(zones.select(F.col("id").alias("_ml_ref")).distinct())
    marked = trips
    bad = F.lit(False)
    for i, col in enumerate(columns):
        ref, hit = f"_ml_ref{i}", f"_ml_hit{i}"
        marked = marked.join(ids.withColumnRenamed("_ml_ref", ref).withColumn(hit, F.lit(True)),
                             F.col(col) == F.col(ref), "left").drop(ref)
        bad = bad | (F.col(col).isNotNull() & F.col(hit).isNull())
    return marked.withColumn(flag, bad).drop(*[f"_ml_hit{i}" for i in range(len(columns))])


def referential_check(trips: DataFrame, zones: DataFrame, columns=("pickup_zone", "dropoff_zone")):
    """(valid, orphans). A NULL reference is valid; a non-NULL id missing from ``zones`` is an orphan."""
    marked = mark_orphans(trips, zones, columns, "_ml_orphan")
    return (marked.where(~F.col("_ml_orphan")).drop("_ml_orphan"),
            marked.where(F.col("_ml_orphan")).drop("_ml_orphan"))


def map_lookup(key: Column, mapping: Mapping, default: Column | str | None = None) -> Column:
    """Code → label through a literal map (no join); ``default`` when the code is unknown or NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), key)
    if default is None:
        return looked
    return F.coalesce(looked, default if isinstance(default, Column) else F.lit(default))


def lookup_payment_label(payment_type: Column) -> Column:
    return map_lookup(payment_type.cast("int"), PAYMENT_LABELS, PAYMENT_LABEL_DEFAULT)


def lookup_flag_note(err_type: Column) -> Column:
    return map_lookup(err_type, FLAG_NOTES, err_type)


def flag_meta_table(spark: SparkSession) -> DataFrame:
    rows = [(k, label, desc, action) for k, (label, desc, action) in FLAG_META.items()]
    return spark.createDataFrame(rows, "err_type string, label string, description string, action string")


def scalar_fields(one_row: DataFrame, prefix: str = "") -> list[Column]:
    """The columns of a one-row aggregate as scalar-subquery Columns (one subquery for all fields)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_ml_s")).scalar()
    return [packed.getField(c).alias(prefix + c) for c in one_row.columns]


def cross_scalar(base: DataFrame, *one_row_frames: DataFrame) -> DataFrame:
    """``base`` with the fields of one-row aggregates appended as scalar subqueries (no join operator)."""
    extra = [c for f in one_row_frames for c in scalar_fields(f)]
    return base.select("*", *extra)
