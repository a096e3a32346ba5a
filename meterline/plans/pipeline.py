"""raw trips → normalise → [hard exclusion] → keep-first dedup → features → post flags → referential check.

Outputs (all lazy DataFrames; nothing passes through the driver):
  trips        kept trips with valid zone references (26 loader columns + row_num)
  quarantine   kept trips that reference a zone id missing from ``zones``
  error_log    one row per raised flag (see operators.errorlog)
  summary      one-row load counters
One shuffle for the dedup; zones are broadcast after a size check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MAX_SPEED_MPH, MAX_TIP_PERCENTAGE, TIMESTAMP_FORMATS
from ..operators.anomalies import with_post_flags
from ..operators.dedup import dedup_keep_first
from ..operators.errorlog import error_rows, flag_rows
from ..operators.features import ENRICHED, enrich
from ..operators.joins import cross_scalar, mark_orphans
from ..operators.normalise import hard_exclusion, normalise
from ..session import STAGED

TRIP_COLUMNS = (
    "row_num", "vendor", "pickup_time", "dropoff_time", "passengers", "distance", "rate_id", "store_fwd",
    "pickup_zone", "dropoff_zone", "payment_type", "fare", "extra", "tax", "tip", "tolls", "surcharge", "total",
    "congestion", "duration_min", "speed_mph", "money_per_min", "tip_pct", "cost_per_mile", "hour_of_day",
    "day_of_week", "is_peak",
)


@dataclass
class Loaded:
    norm: DataFrame        # every raw row, normalised, with raw_flags and hard_code
    kept: DataFrame        # first occurrence of each key among non-excluded rows, enriched, with post_flags
                           # and the referential mark ``orphan``
    created_at: object = None   # time of the run; None: now
    params: tuple = (MAX_SPEED_MPH, MAX_TIP_PERCENTAGE)

    @property
    def trips(self) -> DataFrame:
        return self.kept.where(~F.col("orphan")).select(*TRIP_COLUMNS)

    @property
    def quarantine(self) -> DataFrame:
        return self.kept.where(F.col("orphan")).select(*TRIP_COLUMNS)

    @property
    def error_log(self) -> DataFrame:
        return error_rows(self.flag_rows, self.created_at)

    @property
    def flag_rows(self) -> DataFrame:
        return flag_rows(self.norm, self.kept)

    @property
    def summary(self) -> DataFrame:
        return load_summary(self)

    def staged(self, path: str, zones: DataFrame) -> "Loaded":
        """The load continued from written tables under ``path``: the normalised rows with their flags (one read and parse
        of the raw input) and, from them, the kept trips. Every output and counter reads these tables. Features are neither
        stored nor shuffled with the rows, but made again for those that stay."""
        spark = self.norm.sparkSession
        rows = with_candidates(self.norm, self.params).drop(*ENRICHED)
        rows.write.mode("overwrite").options(**STAGED).parquet(f"{path}/norm")
        norm = spark.read.schema(rows.schema).parquet(f"{path}/norm")
        kept = enrich(build_kept(norm, zones, self.params))
        kept.write.mode("overwrite").options(**STAGED).parquet(f"{path}/kept")
        return Loaded(norm=norm, kept=spark.read.schema(kept.schema).parquet(f"{path}/kept"), created_at=self.created_at, params=self.params)


def load(raw: DataFrame, zones: DataFrame, *, created_at=None, timestamp_formats=TIMESTAMP_FORMATS,
         max_speed: float = MAX_SPEED_MPH, max_tip_pct: float = MAX_TIP_PERCENTAGE) -> Loaded:
    """All rows of ``raw`` through the pipeline, lazily. ``created_at`` is the run's time on the flags (default: now)."""
    norm = normalise(raw, timestamp_formats)
    params = (max_speed, max_tip_pct)
    return Loaded(norm=norm, kept=build_kept(norm, zones, params), created_at=created_at, params=params)


def build_kept(norm: DataFrame, zones: DataFrame, params=(MAX_SPEED_MPH, MAX_TIP_PERCENTAGE)) -> DataFrame:
    """The first occurrences with the orphan mark."""
    return mark_orphans(first_occurrences(norm, params), zones)


def with_candidates(norm: DataFrame, params=(MAX_SPEED_MPH, MAX_TIP_PERCENTAGE)) -> DataFrame:
    """Normalised rows with features and post flags. They depend only on the row itself, so they are computed before the dedup
    window. The raw text (needed only for the anomaly records) is kept only on rows that have a post flag, which keeps it out of
    the staged table and the shuffle for the other ~93% of trips."""
    return with_post_flags(enrich(norm), *params).withColumn("raw", F.when(F.size("post_flags") > 0, F.col("raw")))


def first_occurrences(norm: DataFrame, params=(MAX_SPEED_MPH, MAX_TIP_PERCENTAGE)) -> DataFrame:
    """Non-excluded rows → features → post flags (unless ``norm`` has them) → keep-first dedup.

    Features are computed before the dedup window, so downstream filters on them (``money_per_min IS NOT
    NULL`` …) are predicates on window outputs and are not re-expanded into the feature formulas. Only the
    columns used afterwards enter the dedup shuffle (the raw-flag array stays behind)."""
    # Excluded rows carry NULL pickup/dropoff times in the trip key, so they never share a key with a valid
    # trip: excluding them after the window gives the same survivors, and the exclusion stays a predicate
    # on a window output (not pushed down and re-expanded into the timestamp parsing at the scan).
    candidates = norm.drop("raw_flags")
    candidates = candidates if "post_flags" in norm.columns else with_candidates(candidates, params)
    return hard_exclusion(dedup_keep_first(candidates)).drop("hard_code")


def load_summary(loaded: Loaded) -> DataFrame:
    """total_raw_rows, excluded, duplicates, flagged, clean, inserted, quarantined (one row)."""
    raw_counts = loaded.norm.agg(F.count(F.lit(1)).alias("total_raw_rows"),
                                 F.count_if(F.col("hard_code").isNotNull()).alias("excluded"))
    kept_counts = loaded.kept.agg(F.count(F.lit(1)).alias("kept"),
                                  F.count_if(F.size("post_flags") > 0).alias("flagged"),
                                  F.count_if(~F.col("orphan")).alias("inserted"))
    out = cross_scalar(kept_counts, raw_counts)
    return out.select(
        "total_raw_rows", "excluded",
        (F.col("total_raw_rows") - F.col("excluded") - F.col("kept")).alias("duplicates"),
        "flagged", (F.col("kept") - F.col("flagged")).alias("clean"),
        "inserted", (F.col("kept") - F.col("inserted")).alias("quarantined"),
    )
