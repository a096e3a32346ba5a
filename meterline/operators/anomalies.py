"""Post-enrichment anomaly flags and the open rule registry of the anomaly library.

Two layers, both plain Column predicates:
* ``post_flags`` — the three checks the loader applies to kept trips (HIGH_SPEED, HIGH_TIP_PCT,
  ZERO_DIST_POS_FARE), as flag structs.
* ``RULES`` / ``detect_anomalies`` / ``partition_trips`` — the label-returning checker list of the library
  (zero-distance-positive-fare, excessive speed, invalid duration, excessive tip), open for extension.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import column_cache
from ..config import MAX_SPEED_MPH, MAX_TIP_PERCENTAGE
from ..functions.parsing import js_number_text, parse_float
from .normalise import collect_flags, flag_if


def _num_text(x) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


@column_cache
def post_flags(max_speed: float = MAX_SPEED_MPH, max_tip_pct: float = MAX_TIP_PERCENTAGE) -> Column:
    c = F.col
    speed_t, tip_t, fare_t = js_number_text(c("speed_mph")), js_number_text(c("tip_pct")), js_number_text(c("fare"))
    return collect_flags([
        flag_if(c("speed_mph").isNotNull() & (c("speed_mph") > max_speed), "HIGH_SPEED", "retained",
                F.concat(F.lit("speed_mph is "), speed_t, F.lit(f" (> {_num_text(max_speed)})")), "speed_mph", speed_t),
        flag_if(c("tip_pct").isNotNull() & (c("tip_pct") > max_tip_pct), "HIGH_TIP_PCT", "retained",
                F.concat(F.lit("tip_pct is "), tip_t, F.lit(f" (> {_num_text(max_tip_pct)}%)")), "tip_pct", tip_t),
        flag_if((c("distance") == 0) & (c("fare") > 0), "ZERO_DIST_POS_FARE", "retained",
                F.concat(F.lit("distance=0 but fare="), fare_t), "distance", F.lit("0")),
    ])


def with_post_flags(enriched: DataFrame, max_speed: float = MAX_SPEED_MPH,
                    max_tip_pct: float = MAX_TIP_PERCENTAGE) -> DataFrame:
    return enriched.withColumn("post_flags", post_flags(max_speed, max_tip_pct))


# ---- library checker list ------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    label: str
    predicate: Callable[[], Column]   # evaluated against compute_features output columns


def _zero_distance_positive_fare() -> Column:
    d = F.coalesce(parse_float("trip_distance"), F.lit(0.0))
    f = F.coalesce(parse_float("fare_amount"), F.lit(0.0))
    return (d == 0) & (f > 0)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def _excessive_speed(limit: float = MAX_SPEED_MPH) -> Callable[[], Column]:
    return lambda: _finite(F.col("average_speed_mph")) & (F.col("average_speed_mph") > limit)


def _invalid_duration() -> Column:
    d = F.col("trip_duration_minutes")
    return d.isNull() | (d <= 0)


def _excessive_tip(limit: float = MAX_TIP_PERCENTAGE) -> Callable[[], Column]:
    return lambda: _finite(F.col("tip_percentage")) & (F.col("tip_percentage") > limit)


# Ordered: the label order of the output array follows this list.
RULES: list[Rule] = [
    Rule("zero_distance_positive_fare", _zero_distance_positive_fare),
    Rule("excessive_speed", _excessive_speed()),
    Rule("invalid_duration", _invalid_duration),
    Rule("excessive_tip_percentage", _excessive_tip()),
]


def detect_anomalies(rules: Sequence[Rule] = None) -> Column:
    """Ordered ``array<string>`` of the labels whose predicate holds (empty when clean)."""
    rules = RULES if rules is None else rules
    return F.filter(F.array(*[F.when(r.predicate(), F.lit(r.label)) for r in rules]), lambda x: x.isNotNull())


def anomaly_detail(types: Column) -> Column:
    return F.struct(
        types.alias("anomaly_types"),
        F.col("trip_distance"), F.col("fare_amount"), F.col("average_speed_mph"),
        F.col("trip_duration_minutes"), F.col("tip_percentage"),
    )


def label_trips(featured: DataFrame, rules: Sequence[Rule] = None) -> DataFrame:
    """All rows with ``types`` (labels that hold) and ``detail`` (NULL for clean rows). Callers that read both halves
    more than once cache or write this frame themselves.

    The labels come out of an ``explode`` of one element: a filter on them stays above it. Of a plain column the optimizer
    pushes the filter down to the scan and there writes out every feature and parsed text that a rule reads, once per use."""
    labelled = featured.select("*", F.explode(F.array(detect_anomalies(rules))).alias("types"))
    return labelled.withColumn("detail", F.when(F.size("types") > 0, anomaly_detail(F.col("types"))))


def partition_trips(featured: DataFrame, rules: Sequence[Rule] = None) -> tuple[DataFrame, DataFrame]:
    """(clean, anomalies): anomalies carry ``types`` and a ``detail`` struct."""
    labelled = label_trips(featured, rules)
    return labelled.where(F.size("types") == 0).drop("types", "detail"), labelled.where(F.size("types") > 0)
