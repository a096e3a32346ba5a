"""Aggregation helpers: exact averages, percentiles, ratios, and the generic group helpers of the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ..functions.parsing import parse_float
from ..functions.rounding import exact_avg, exact_sum, to_fixed

def value_range(v: Column) -> Column:
    """Number of the value range that holds ``v``, never falling with ``v``: sixteenths up to 4096, beyond that 64 ranges for
    each doubling. There are at most some 400,000, whatever the data."""
    far = F.lit(1 << 16) + F.floor(F.least(F.log2(F.abs(v)), F.lit(2000.0)) * F.lit(64.0))
    return (F.when(F.isnan(v), F.lit(1 << 40)).when(F.abs(v) < 4096, F.floor(v * F.lit(16.0)))
            .when(v > 0, far).otherwise(-far))


def value_counts(rows: DataFrame, keys: dict[str, Column], values: list[Column]) -> DataFrame:
    """Partial for percentiles: how often (``n``) each value (``v``) of the ``i``-th column occurs in each group. Counts of several
    frames are merged by adding them. NULL values don't count."""
    each = F.posexplode(F.array(*[c.cast("double") for c in values])).alias("i", "v")
    long = rows.select(*[k.alias(n) for n, k in keys.items()], each).where(F.col("v").isNotNull())
    return long.groupBy(*keys, "i", "v").agg(F.count(F.lit(1)).alias("n"))


def percentiles_from_counts(counts: DataFrame, keys: list[str], wanted: dict[str, tuple[int, float]]) -> DataFrame:
    """One row per group: ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY v)`` of the ``i``-th column for each name: (i, p), from value
    counts (rows of the same group, i and v add up). Exact linear interpolation.

    A search by running counts in two levels: over the value ranges of a group, of which there are boundedly many, and
    then over the values of the one or two ranges that hold the wanted places. No task holds all values of a group, and a
    place is always found, since every value lies in a range."""
    own = [f"_ml_k_{k}" for k in keys]
    counts = counts.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], "i", "v", "n", value_range(F.col("v")).alias("r"))
    group = Window.partitionBy(*own, "i")
    ranges = counts.groupBy(*own, "i", "r").agg(F.sum("n").alias("_ml_in"))
    ranges = ranges.withColumn("_ml_upto", F.sum("_ml_in").over(group.orderBy("r"))).withColumn("_ml_all", F.sum("_ml_in").over(group))
    places = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(i).alias("of"), F.lit(float(p)).alias("p")) for j, (i, p) in enumerate(wanted.values())])).alias("w")
    asked = ranges.select("*", places).where(F.col("w.of") == F.col("i")).withColumn("_ml_at", F.col("w.p") * (F.col("_ml_all") - 1))
    asked = asked.withColumn("_ml_before", F.col("_ml_upto") - F.col("_ml_in"))
    holds = lambda at: (F.col("_ml_before") <= at) & (at < F.col("_ml_upto"))
    low, high = F.floor("_ml_at"), F.ceil("_ml_at")
    asked = asked.where(holds(low) | holds(high)).select(*[F.col(o).alias(f"{o}_") for o in own], F.col("i").alias("i_"), F.col("r").alias("r_"), "w.j", "_ml_before", "_ml_at")
    # null-safe also where there are no nulls: else the optimizer filters them in one branch, and the counts are made twice
    same = [F.col(o).eqNullSafe(F.col(f"{o}_")) for o in (*own, "i", "r")]
    inside = counts.join(asked, same)
    inside = inside.groupBy(*own, "j", "r", "_ml_before", "_ml_at", "v").agg(F.sum("n").alias("n"))
    upto = F.col("_ml_before") + F.sum("n").over(Window.partitionBy(*own, "j", "r").orderBy("v"))
    inside = inside.withColumn("_ml_upto", upto)
    value = lambda at: F.max(F.when((F.col("_ml_upto") - F.col("n") <= at) & (at < F.col("_ml_upto")), F.col("v")))
    found = inside.groupBy(*own, "j").agg(value(low).alias("_ml_low"), value(high).alias("_ml_high"), F.max(F.col("_ml_at") - low).alias("_ml_share"))
    between = F.col("_ml_low") + (F.col("_ml_high") - F.col("_ml_low")) * F.col("_ml_share")
    return (found.groupBy(*own).agg(*[F.max(F.when(F.col("j") == j, between)).alias(name) for j, name in enumerate(wanted)])
            .withColumnsRenamed(dict(zip(own, keys))))


def with_percentiles(aggregated: DataFrame, rows: DataFrame, keys: dict[str, Column], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """``aggregated`` (one row per group, key columns named as in ``keys``) with ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY c)``
    for each ``wanted`` name: (c, p), over the ``rows`` of the group. ``rows`` is read once, for the counts of its values."""
    counts = value_counts(rows, keys, [c for c, _ in wanted.values()])
    return join_percentiles(aggregated, counts, list(keys), {name: (i, p) for i, (name, (_, p)) in enumerate(wanted.items())})


def join_percentiles(aggregated: DataFrame, counts: DataFrame, keys: list[str], wanted: dict[str, tuple[int, float]]) -> DataFrame:
    own = [f"_ml_k_{k}" for k in keys]
    found = percentiles_from_counts(counts, keys, wanted).withColumnsRenamed(dict(zip(keys, own)))
    return aggregated.join(found, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)], "left").drop(*own)


def bitmap_partials(rows: DataFrame, values: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Partial for distinct counts of whole numbers that lie close together: bitmaps (``bits``) by ``kind`` and ``bucket`` of 32,768
    numbers, negative ones included. Partials of several frames are merged by OR."""
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("bigint").alias("v")) for k, c in values.items()]))
    long = rows.select(*(keys or []), each).where(F.col("v").isNotNull())
    return (long.groupBy(*(keys or []), "kind", F.bitmap_bucket_number("v").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")))


def distinct_from_bitmaps(partials: DataFrame, kinds: list[str], keys: list[str] | None = None) -> DataFrame:
    """Exact distinct counts, a column for each of ``kinds``."""
    merged = partials.groupBy(*(keys or []), "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*(keys or [])).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("bigint").alias(k) for k in kinds])


def ratio_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, digits)`` (NULL when den is 0)."""
    return to_fixed(F.try_divide(num, F.nullif(den, F.lit(0.0))) * F.lit(100), digits)


def group_key(key: Column) -> Column:
    """Group label as text; NULL becomes 'null' (keys are coerced to strings)."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def group_by_key(df: DataFrame, key: Column) -> GroupedData:
    """Distributed equivalent of grouping rows into key → members: a GroupedData on the text key.
    Members stay distributed; nothing is collected into one task."""
    return df.groupBy(group_key(key).alias("group_key"))


def aggregate_groups(df: DataFrame, key: Column, numeric: str) -> DataFrame:
    """Per group: count of numeric values, sum, min, max, avg (4 dp). Non-numeric values are skipped; a
    group without numeric values gives count 0, sum 0 and NULL min/max/avg."""
    v = parse_float(F.col(numeric).cast("string"))
    return (group_by_key(df.withColumn("_ml_v", v), key)
            .agg(F.count("_ml_v").alias("count"),
                 F.coalesce(exact_sum("_ml_v"), F.lit(0.0)).alias("_s"),
                 F.min("_ml_v").alias("_mn"), F.max("_ml_v").alias("_mx"), exact_avg("_ml_v").alias("_a"))
            .select("group_key", F.col("count").cast("bigint").alias("count"),
                    to_fixed(F.col("_s"), 4).alias("sum"), to_fixed(F.col("_mn"), 4).alias("min"),
                    to_fixed(F.col("_mx"), 4).alias("max"), to_fixed(F.col("_a"), 4).alias("avg")))
