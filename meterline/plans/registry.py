"""Every registered query: name → callable(spark, sf_dir) → DataFrame.

Each callable derives the trip fixture from the given tables of ``sf_dir``, runs the load pipeline lazily
and applies one operator or named query. Timestamps are returned as ISO-8601 UTC text (the API's JSON form).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FLAG_META, POST_FLAG_TYPES, RAW_TRIP_COLUMNS
from ..functions.formats import fmt_date, fmt_hr, fmt_k, fmt_num, fmt_rpm, fmt_usd, iso_timestamp
from ..operators.aggs import aggregate_groups, distinct_from_bitmaps, group_by_key
from ..operators.anomalies import detect_anomalies, partition_trips
from ..operators.dedup import dedup_keep_first, dedup_with_count, trip_key_text
from ..functions.rounding import to_fixed
from ..operators.errorlog import json_extract_num, post_rows, quality_rows
from ..operators.features import compute_features
from ..operators.joins import cross_scalar, exists_in, join_zone_inner, lookup_flag_note, lookup_payment_label
from ..operators.normalise import hard_exclusion
from ..operators.geo import zone_shapes
from ..operators.sinks import write_loaded
from ..operators.sorting import sort_by_any_column, stable_sort
from ..session import free_shuffles, path_exists, shared_dir
from ..sources.csv import number_rows, scan_trips_csv, scan_zones_csv
from ..sources.polygons import scan_zone_polygons
from ..sources.tables import read_table
from . import anomalies, client, overview, profitability, stats, tips
from .files import load_files
from .pipeline import TRIP_COLUMNS, load
from .rollups import bitmaps, flags
from .tables import FIXTURE_CREATED_AT, Tables, fixture_inputs, from_store, from_testdata

Query = Callable[[SparkSession, str], DataFrame]


def _iso_trips(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, *[iso_timestamp(c).alias(c) if c in ("pickup_time", "dropoff_time") else F.col(c)
                       for c in TRIP_COLUMNS])


def _t(fn) -> Query:
    return lambda spark, sf: fn(from_testdata(spark, sf))


def _error_rows(df: DataFrame) -> DataFrame:
    return df.select("err_id", "row_num", "err_type", "details", "raw_data",
                     iso_timestamp("created_at").alias("created_at"), "source")


def _flag_query(code: str) -> Query:
    """Flags of raw rows need no dedup; flags of kept trips don't need the others."""
    def rows(t: Tables) -> DataFrame:
        made = post_rows(t.loaded.kept, t.loaded.created_at) if code in POST_FLAG_TYPES else quality_rows(t.loaded.norm, "raw_flags", t.loaded.created_at)
        return _error_rows(made.where(F.col("err_type") == code))
    return _t(rows)


def _library_features(spark, sf):
    raw, _, _ = fixture_inputs(spark, sf)
    renamed = raw.select("row_num", F.col("tpep_pickup_datetime").alias("pickup_datetime"),
                         F.col("tpep_dropoff_datetime").alias("dropoff_datetime"), "trip_distance", "total_amount",
                         "tip_amount", "fare_amount")
    return compute_features(renamed)


def _features(t: Tables) -> DataFrame:
    return t.loaded.kept.select("row_num", "duration_min", "speed_mph", "money_per_min", "tip_pct", "cost_per_mile",
                                "hour_of_day", "day_of_week", "is_peak")


def _dedup_first(t: Tables) -> DataFrame:
    first = dedup_keep_first(hard_exclusion(t.loaded.norm))
    return first.select("row_num", trip_key_text().alias("trip_key"))


def _dedup_counts(t: Tables) -> DataFrame:
    _, counts = dedup_with_count(hard_exclusion(t.loaded.norm))
    return counts


def _zone_inner(t: Tables) -> DataFrame:
    return join_zone_inner(t.trips, t.zones).select(F.col("t.row_num").alias("row_num"),
                                                    F.col("t.pickup_zone").alias("pickup_zone"),
                                                    F.col("z.borough").alias("borough"),
                                                    F.col("z.zone_name").alias("zone_name"))


def _exists_shape(t: Tables) -> DataFrame:
    return exists_in(t.zones.select("id"), t.zone_shapes, "id", "location_id", "has_shape", F.col("mappable"))


def _payment_labels(t: Tables) -> DataFrame:
    return (t.trips.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trips"))
            .withColumn("payment_label", lookup_payment_label(F.col("payment_type"))))


def _flag_notes(t: Tables) -> DataFrame:
    return anomalies.by_type(t).withColumn("note", lookup_flag_note(F.col("err_type")))


def _count_distinct(t: Tables) -> DataFrame:
    zones = distinct_from_bitmaps(bitmaps(t), ["unique_pickup_zones", "unique_dropoff_zones"])
    rows = flags(t).where(F.col("err_type").isNull()).select(F.col("count").alias("unique_flagged_rows"))
    return cross_scalar(zones, rows)


def _aggregate_groups(t: Tables) -> DataFrame:
    joined = join_zone_inner(t.trips, t.zones).select(F.col("z.borough").alias("borough"), F.col("t.fare").alias("fare"))
    return aggregate_groups(joined, F.col("borough"), "fare")


def _group_by_key(t: Tables) -> DataFrame:
    return group_by_key(t.trips, F.col("payment_type")).agg(F.count(F.lit(1)).alias("members"))


def _stable_sort(t: Tables) -> DataFrame:
    return _iso_trips(stable_sort(t.trips, [F.col("fare").asc()], position="position"), "position")


def _sort_any(t: Tables) -> DataFrame:
    # every second name in lower case: a code-point order would part them, the locale's order doesn't
    mixed = F.when(F.col("location_id") % 2 == 0, F.lower("zone_name")).otherwise(F.col("zone_name"))
    ranked = client.profit_ranking(t).drop("rank").withColumn("zone_name", mixed)
    return number_rows(sort_by_any_column(ranked, "zone_name", descending=True, tie_col="location_id"), "position")


def _detect(spark, sf):
    return _library_features(spark, sf).select("row_num", F.array_join(detect_anomalies(), ",").alias("anomaly_types"))


def _rounded_frame(df: DataFrame, *columns: str) -> DataFrame:
    """Percentiles rounded for the comparison only: engines interpolate with different last bits."""
    return df.select(*[to_fixed(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


def _rounded(query: Callable[[Tables], DataFrame], *columns: str) -> Query:
    return _t(lambda t: _rounded_frame(query(t), *columns))


def _aggregate_long_decimals(spark, sf):
    """Values with up to 7 decimals, so that any rounding before the sum shows."""
    li = read_table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_partkey").cast("double") / F.lit(1e7)).alias("v"))
    return aggregate_groups(li, F.col("l_returnflag"), "v")


_built: dict[tuple[str, str, str], str] = {}


def _once(spark, sf: str, name: str, build: Callable[[], str]) -> str:
    """Folder that ``build`` writes from the given tables: made by the first query of a session that reads it, as long as it
    stands. The queries over it then read the same store or stream output."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _built or not path_exists(spark, _built[key]):
        _built[key] = build()
    return _built[key]


def _two_loads(spark, sf) -> Tables:
    """The fixture in two loads that share their days, stored side by side and read back (the store is named by URI).
    Equal trip keys have equal times, so they fall in the same load."""
    def build() -> str:
        raw, zones, features = fixture_inputs(spark, sf)
        root = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
        root = root if ":/" in root else f"file://{root}"
        half = F.pmod(F.xxhash64("tpep_pickup_datetime", "tpep_dropoff_datetime"), F.lit(2))
        for n in range(2):
            write_loaded(load(raw.where(half == n), zones, created_at=FIXTURE_CREATED_AT), zones, root, zone_shapes(features), load_id=f"part{n}")
        return root
    return from_store(spark, _once(spark, sf, "two_loads", build))


def _late_zones(spark, sf) -> Tables:
    """Two loads, of which only the second brings half of the zones: rows of the first that wait for them are taken in then."""
    def build() -> str:
        raw, zones, features = fixture_inputs(spark, sf)
        root = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
        half = F.pmod(F.xxhash64("tpep_pickup_datetime", "tpep_dropoff_datetime"), F.lit(2))
        for n, known in enumerate((zones.where("id <= 12"), zones)):
            write_loaded(load(raw.where(half == n), known, created_at=FIXTURE_CREATED_AT), known, root, zone_shapes(features), load_id=f"part{n}")
        return root
    return from_store(spark, _once(spark, sf, "late_zones", build))


def _store(fn) -> Query:
    return lambda spark, sf: fn(_two_loads(spark, sf))


def _scan_zones_csv(spark, sf):
    _, zones, _ = fixture_inputs(spark, sf)
    path = f"{shared_dir(spark)}/zones-csv-{uuid.uuid4().hex}"
    named = zones.select(F.col("id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"), "service_zone")
    named.write.option("header", True).csv(path)
    return scan_zones_csv(spark, path)


def _scan_polygons(spark, sf):
    _, _, features = fixture_inputs(spark, sf)
    path = f"{shared_dir(spark)}/polygons-{uuid.uuid4().hex}"
    features.write.json(path)
    return zone_shapes(scan_zone_polygons(spark, path), web_digits=7)


def _summary_types(t: Tables) -> DataFrame:
    s = anomalies.summary_with_types(t)
    text = F.array_join(F.transform("by_type", lambda x: F.concat(x["err_type"], F.lit("="), x["count"].cast("string"))), ",")
    return s.withColumn("by_type", text)


def _limits(t: Tables) -> DataFrame:
    """The limit rule at its edges, on the list's meta row."""
    given = ("15abc", "0", None, "x", 7, 10_000)
    metas = [anomalies.anomaly_list(t, g, 0)[1].select(F.lit(n).alias("case_no"), "limit", "count") for n, g in enumerate(given)]
    return reduce(DataFrame.union, metas)


def _streamed(spark, sf) -> str:
    from ..streaming.ingest import stream_fixture
    return _once(spark, sf, "stream", lambda: stream_fixture(spark, sf))


def _redelivered(spark, sf) -> str:
    from ..streaming.ingest import stream_redelivery
    return _once(spark, sf, "redelivery", lambda: stream_redelivery(spark, sf))


def _stream_counters(spark, sf):
    from ..streaming.ingest import stream_summary
    return stream_summary(spark, _streamed(spark, sf))


def _redelivered_trips(spark, sf):
    return _iso_trips(spark.read.parquet(f"{_redelivered(spark, sf)}/trips"))


def _late_rows(spark, sf):
    late = spark.read.parquet(f"{_redelivered(spark, sf)}/late")
    return late.select("row_num", iso_timestamp("pickup_time").alias("pickup_time"), "total")


def _redelivery_counters(spark, sf):
    from ..streaming.ingest import stream_summary
    return stream_summary(spark, _redelivered(spark, sf))


def _second_page(t: Tables, flag_type: str | None = None) -> DataFrame:
    t = anomalies.with_written_list(t, flag_type)
    last = anomalies.anomaly_page(t, 50, None, flag_type).select("cursor").tail(1)
    return anomalies.anomaly_page(t, 50, last[0].cursor if last else None, flag_type).drop("cursor")


def _files(spark, sf) -> Tables:
    """The fixture as files (trips in several, in row order, compressed), loaded by one call from their paths."""
    def build() -> str:
        raw, zones, features = fixture_inputs(spark, sf)
        at = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
        _write_trips_csv(raw, f"{at}/trips")
        named = zones.select(F.col("id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"), "service_zone")
        named.write.option("header", True).csv(f"{at}/zones")
        features.write.json(f"{at}/polygons")
        load_files(spark, f"{at}/store", f"{at}/trips", f"{at}/zones", f"{at}/polygons", created_at=FIXTURE_CREATED_AT)
        return f"{at}/store"
    return from_store(spark, _once(spark, sf, "files", build))


def _partition(spark, sf):
    clean, anomalous = partition_trips(_library_features(spark, sf))
    detail = ("trip_distance", "fare_amount", "average_speed_mph", "trip_duration_minutes", "tip_percentage")
    bad = anomalous.select("row_num", F.lit("anomaly").alias("half"), F.array_join("detail.anomaly_types", ",").alias("anomaly_types"), *[F.col(f"detail.{c}").alias(c) for c in detail])
    good = clean.select("row_num", F.lit("clean").alias("half"), F.lit(None).cast("string").alias("anomaly_types"), *[F.lit(None).cast(bad.schema[c].dataType).alias(c) for c in detail])
    return bad.union(good)


def _formats_by_hour(t: Tables) -> DataFrame:
    return profitability.by_hour(t).select(
        "hour_of_day", fmt_hr(F.col("hour_of_day")).alias("hour_label"), fmt_num(F.col("trip_count")).alias("trips_text"),
        fmt_usd(F.col("avg_fare")).alias("fare_text"), fmt_rpm(F.col("avg_revenue_per_minute")).alias("rpm_text"),
        fmt_k(F.col("trip_count")).alias("k_text"))


def _formats_by_day(t: Tables) -> DataFrame:
    days = (t.trips.groupBy(F.date_trunc("day", "pickup_time").alias("day")).agg(F.count(F.lit(1)).alias("trip_count")))
    return days.select(iso_timestamp("day").alias("period"), fmt_date(F.col("day")).alias("day_label"),
                       fmt_num(F.col("trip_count")).alias("trips_text"))


def _events_json(spark, sf):
    ev = read_table(spark, sf, "events")
    k = json_extract_num(F.col("props"), "k").try_cast("bigint")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum(k).alias("k_sum"),
                                       F.count(k).alias("k_present"))


def _events_by_hour(spark, sf):
    ev = read_table(spark, sf, "events")
    return (ev.groupBy(F.date_trunc("hour", "ts").alias("_h")).agg(F.count(F.lit(1)).alias("events"),
                                                                  F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("value_sum"))
            .select(iso_timestamp("_h").alias("period"), "events", "value_sum"))


def _stream_trips(spark, sf):
    return _iso_trips(spark.read.parquet(f"{_streamed(spark, sf)}/trips").drop("epoch"))


def _stream_hourly(spark, sf):
    from ..streaming.ingest import stream_hourly_stats
    return stream_hourly_stats(spark, _streamed(spark, sf))


#: Bytes of trips, as the optimizer estimates them, in one of the files that they are written to.
_FILE_BYTES = 32 << 20


def _write_trips_csv(raw: DataFrame, path: str) -> None:
    """The raw trips as CSV files in row order: four, and more as the table grows, so that a file's sort stays small."""
    estimate = int(str(raw._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(4, -(-estimate // _FILE_BYTES))
    raw.repartitionByRange(files, "row_num").sortWithinPartitions("row_num").select(*RAW_TRIP_COLUMNS).write.option("header", True).option("compression", "gzip").csv(path)
    free_shuffles(raw.sparkSession)


def _scan_csv(spark, sf):
    """The fixture written as CSV files (header, in row order, several files) under the shared folder and read
    back with the trip CSV reader: row numbers are the 1-based positions in file order."""
    raw, _, _ = fixture_inputs(spark, sf)
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    _write_trips_csv(raw, path)
    return scan_trips_csv(spark, path)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / fixtures
        "scan_raw_trips": lambda spark, sf: fixture_inputs(spark, sf)[0],
        "scan_zones": lambda spark, sf: fixture_inputs(spark, sf)[1],
        "scan_trips_csv": _scan_csv,
        # pipeline outputs
        "trips": _t(lambda t: _iso_trips(t.trips)),
        "referential_orphans": _t(lambda t: _iso_trips(t.loaded.quarantine)),
        "error_log": _t(lambda t: _error_rows(t.error_log)),
        "load_summary": _t(lambda t: t.loaded.summary),
        "features": _t(_features),
        "compute_features": lambda spark, sf: _library_features(spark, sf).select(
            "row_num", "trip_duration_minutes", "average_speed_mph", "revenue_per_minute", "tip_percentage"),
        "detect_anomalies": _detect,
        "partition_trips": _partition,
        "dedup_keep_first": _t(_dedup_first),
        "dedup_with_count": _t(_dedup_counts),
        # joins and lookups
        "join_zone_inner": _t(_zone_inner),
        "exists_shape": _t(_exists_shape),
        "lookup_payment_label": _t(_payment_labels),
        "lookup_flag_note": _t(_flag_notes),
        # aggregates and sorting
        "agg_count_distinct": _t(_count_distinct),
        "aggregate_groups": _t(_aggregate_groups),
        "group_by_key": _t(_group_by_key),
        "aggregate_groups_long_decimals": _aggregate_long_decimals,
        "stable_sort": _t(_stable_sort),
        "scan_zones_csv": _scan_zones_csv,
        "scan_zone_polygons": _scan_polygons,
        # two loads stored side by side
        "store_two_loads_trips": _store(lambda t: _iso_trips(t.trips)),
        "store_two_loads_error_log": _store(lambda t: _error_rows(t.error_log)),
        "store_zone_stats": _store(stats.zone_stats),
        "store_hourly_stats": _store(stats.hourly_stats),
        "store_zones": _store(lambda t: t.zones.select("id", "borough", "zone_name", "service_zone")),
        "store_readmitted_trips": lambda spark, sf: _iso_trips(_late_zones(spark, sf).trips),
        "store_readmitted_quarantine": lambda spark, sf: _iso_trips(_late_zones(spark, sf).quarantine),
        "store_readmitted_zone_stats": lambda spark, sf: stats.zone_stats(_late_zones(spark, sf)),
        "store_profitability_by_borough": lambda spark, sf: _rounded_frame(profitability.by_borough(_two_loads(spark, sf)), "median_fare", "median_revenue_per_minute"),
        "store_tips_payment_comparison": lambda spark, sf: _rounded_frame(tips.payment_comparison(_two_loads(spark, sf)), "median_tip_percentage", "p90_tip_percentage"),
        "anomalies_page_after": _t(_second_page),
        "anomalies_page_after_typed": _t(lambda t: _second_page(t, "HIGH_SPEED")),
        "store_anomalies_page_after": _store(_second_page),
        "store_anomalies_list": _store(lambda t: anomalies.anomaly_list(t)[0]),
        "load_files_trips": lambda spark, sf: _iso_trips(_files(spark, sf).trips),
        "load_files_zone_stats": lambda spark, sf: stats.zone_stats(_files(spark, sf)),
        "store_overview_kpis": _store(overview.overview_kpis),
        "store_anomalies_summary": _store(_summary_types),
        "sort_by_any_column": _t(_sort_any),
        # named queries
        "overview_kpis": _t(overview.overview_kpis),
        "overview_trips_over_time_day": _t(lambda t: overview.trips_over_time(t, "day")),
        "overview_trips_over_time_hour": _t(lambda t: overview.trips_over_time(t, "hour")),
        "overview_top_zones": _t(lambda t: overview.top_zones(t)),
        "overview_trips_over_time_meta": _t(lambda t: overview.trips_over_time_meta(t, "hour")[1]),
        "overview_top_zones_meta": _t(lambda t: overview.top_zones_meta(t, "15")[1]),
        "overview_top_zones_100": _t(lambda t: overview.top_zones(t, 100)),
        "profitability_top_zones": _t(lambda t: profitability.top_profitable_zones(t)),
        "profitability_by_borough": _rounded(profitability.by_borough, "median_fare", "median_revenue_per_minute"),
        "profitability_by_hour": _t(profitability.by_hour),
        "tips_by_borough": _rounded(tips.tips_by_borough, "median_tip_percentage"),
        "tips_by_hour": _rounded(tips.tips_by_hour, "median_tip_percentage"),
        "tips_payment_comparison": _rounded(tips.payment_comparison, "median_tip_percentage", "p90_tip_percentage"),
        "anomalies_summary": _t(anomalies.summary),
        "anomalies_summary_with_types": _t(_summary_types),
        "clamp_limit": _t(_limits),
        "anomalies_by_type": _t(anomalies.by_type),
        "anomalies_list": _t(lambda t: anomalies.anomaly_list(t)[0]),
        "anomalies_list_meta": _t(lambda t: anomalies.anomaly_list(t)[1]),
        "anomalies_list_typed_page2": _t(lambda t: anomalies.anomaly_list(t, 50, 50, "HIGH_SPEED")[0]),
        "anomalies_list_typed_page2_meta": _t(lambda t: anomalies.anomaly_list(t, 50, 50, "HIGH_SPEED")[1]),
        "hourly_stats": _t(stats.hourly_stats),
        "zone_stats": _t(stats.zone_stats),
        "zone_shapes": lambda spark, sf: zone_shapes(fixture_inputs(spark, sf)[2], web_digits=7),
        "client_borough_volume": _t(lambda t: client.borough_volume(t, client.borough_order_from_zones(t.zones))),
        "client_profit_ranking": _t(client.profit_ranking),
        "client_tip_payment_split": _t(client.tip_payment_split),
        "client_tip_insight": _t(client.tip_insight),
        "client_flag_table": _t(client.flag_table),
        "client_top_flag": _t(client.top_flag),
        "client_flag_legend": _t(client.flag_legend),
        "client_top_zones_table": _t(client.top_zones_table),
        "client_kpi_cards": _t(client.kpi_cards),
        "client_anomaly_cards": _t(client.anomaly_cards),
        "display_formats_by_hour": _t(_formats_by_hour),
        "display_formats_by_day": _t(_formats_by_day),
        # other given tables
        "events_json_extract": _events_json,
        "events_by_hour": _events_by_hour,
        # streaming (availableNow run, result read back as a table)
        "stream_trips": _stream_trips,
        "stream_hourly_stats": _stream_hourly,
        "stream_counters": _stream_counters,
        "stream_redelivery_trips": _redelivered_trips,
        "stream_late_rows": _late_rows,
        "stream_redelivery_counters": _redelivery_counters,
    }
    for code in FLAG_META:
        q[f"flag_{code.lower()}"] = _flag_query(code)
    return q
