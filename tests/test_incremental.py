"""Partials per load, the version pointer, zones of loads at once, rows that wait for a zone, percentiles from counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.functions.rounding import exact_avg, exact_sum, merged_parts, parts_avg, parts_sum, sum_parts
from meterline.operators.aggs import bitmap_partials, distinct_from_bitmaps, percentiles_from_counts, value_counts, value_range
from meterline.operators.geo import zone_shapes
from meterline.operators.paging import page_end, read_cursor
from meterline.operators.sinks import WAITED, first_stored, waiting, write_loaded, write_part
from meterline.plans import anomalies, overview, profitability, stats, tips
from meterline.plans.pipeline import load
from meterline.plans.tables import PARTIALS, fixture_inputs, from_store
from meterline.plans.files import load_files
from meterline.session import child_names, current_version, read_version, switch_version
from meterline.sources.csv import number_rows
from tests.conftest import SF_SMALL

QUERIES = {
    "kpis": overview.overview_kpis, "days": overview.trips_over_time, "top": overview.top_zones, "profit": profitability.top_profitable_zones,
    "borough": profitability.by_borough, "hour": profitability.by_hour, "tips_borough": tips.tips_by_borough, "tips_hour": tips.tips_by_hour,
    "payment": tips.payment_comparison, "flags": anomalies.by_type, "summary": anomalies.summary, "hourly": stats.hourly_stats, "zones": stats.zone_stats,
}


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Three loads; the first knows only some zones, and all number their rows from 1."""
    raw, zones, features = fixture_inputs(spark, SF_SMALL)
    root = f"file://{tmp_path_factory.mktemp('store')}"
    part = F.pmod(F.xxhash64("tpep_pickup_datetime", "tpep_dropoff_datetime"), F.lit(3))
    for n in range(3):
        known = zones.where("id <= 12") if n == 0 else zones
        write_loaded(load(raw.where(part == n), known), known, root, zone_shapes(features) if n == 0 else None, load_id=f"l{n}")
    return root


def test_partials_give_what_all_trips_give(spark, store):
    t = from_store(spark, store)
    assert all(t.partials(name) is not None for name in PARTIALS)
    plain = from_store(spark, store)
    plain.partials = lambda name: None
    for name, query in QUERIES.items():
        assert rows_of(query(t)) == rows_of(query(plain)), name


def test_named_queries_read_no_trips(spark, store):
    t = from_store(spark, store)
    for name, query in QUERIES.items():
        plan = query(t)._jdf.queryExecution().executedPlan().toString()
        assert "/trips" not in plan and "/error_log" not in plan, name


def test_summary_tables_are_current_and_switch_as_a_whole(spark, store):
    t = from_store(spark, store)
    assert rows_of(read_version(spark, store, "hourly_stats")) == rows_of(stats.hourly_stats(t))
    assert rows_of(read_version(spark, store, "zone_stats")) == rows_of(stats.zone_stats(t))
    opened = read_version(spark, store, "zone_stats")
    before = opened.count()
    version = current_version(spark, store, "zone_stats")
    for n in range(3):
        switch_version(spark, store, "scratch", spark.range(n + 1))
        assert read_version(spark, store, "scratch").count() == n + 1
    assert len([c for c in child_names(spark, f"{store}/scratch") if c.startswith("v-")]) == 2
    switch_version(spark, store, "zone_stats", stats.zone_stats(t))
    assert current_version(spark, store, "zone_stats") != version and opened.count() == before


def test_rows_that_waited_become_trips_exactly_once(spark, store):
    raw, zones, features = fixture_inputs(spark, SF_SMALL)
    part = F.pmod(F.xxhash64("tpep_pickup_datetime", "tpep_dropoff_datetime"), F.lit(3))
    whole = load(raw, zones)

    def state():
        t = from_store(spark, store)
        ids = sorted(r.row_num for r in t.trips.select("row_num").collect())
        return ids, sorted(r.row_num for r in waiting(spark, store).select("row_num").collect()), rows_of(stats.zone_stats(t))

    trips, left = (sorted(r.row_num for r in x.select("row_num").collect()) for x in (whole.trips, whole.quarantine))
    first = state()
    assert first[:2] == (trips, left) and f"load_id=l0{WAITED}l1" in child_names(spark, f"{store}/trips")
    write_loaded(load(raw.where(part == 1), zones), zones, store, load_id="l1")  # the load that brought the zones again
    assert state() == first
    write_loaded(load(raw.where(part == 0), zones), zones, store, load_id="l0")  # the load whose rows waited again
    assert state() == first and not any(WAITED in n for n in child_names(spark, f"{store}/trips"))


def test_zones_of_loads_at_once(spark, scratch):
    """Two loads that don't see each other's zones both insert an id."""
    schema = "id int, borough string, zone_name string, service_zone string, inserted_at timestamp"
    for load_id, second, borough in (("b", 1, "early"), ("a", 2, "late")):
        rows = spark.createDataFrame([(7, borough, "z", "s"), (8 if load_id == "a" else 9, "own", "z", "s")], "id int, borough string, zone_name string, service_zone string")
        write_part(rows.withColumn("inserted_at", F.timestamp_seconds(F.lit(second))).select(*[c.split()[0] for c in schema.split(", ")]), scratch, "zones", load_id)
    zones = first_stored(spark.read.parquet(f"{scratch}/zones"))
    assert {r.id: r.borough for r in zones.collect()} == {7: "early", 8: "own", 9: "own"} and zones.count() == 3
    trips = spark.createDataFrame([(7,)] * 3, "pickup_zone int")
    assert trips.join(zones, trips.pickup_zone == zones.id).count() == 3


def test_flagged_rows_of_loads_that_number_alike(spark, scratch):
    raw, zones, features = fixture_inputs(spark, SF_SMALL)
    few = number_rows(raw.orderBy("row_num").limit(2000).drop("row_num"))
    for n in range(2):
        write_loaded(load(few, zones), zones, f"{scratch}/store", load_id=f"n{n}")
    one = load(few, zones).error_log.where(~F.col("err_type").isin("BAD_DATETIME", "DROPOFF_BEFORE_PICKUP")).select("row_num").distinct().count()
    t = from_store(spark, f"{scratch}/store")
    assert anomalies.summary(t).first().unique_flagged_rows == 2 * one
    t.partials = lambda name: None
    query = anomalies.summary(t)
    assert query.first().unique_flagged_rows == 2 * one and "Expand" not in query._jdf.queryExecution().executedPlan().toString()


def test_parts_merge_to_the_exact_sum(spark):
    rng = np.random.default_rng(3)
    values = [0.00001, 0.00001, 0.00004, 10.1234567, 1e16, 1e16, -3.25, None, *map(float, np.round(rng.normal(0, 100, 500), 2)), *map(float, rng.normal(0, 1, 200))]
    df = spark.createDataFrame([(v, n % 7, n % 3) for n, v in enumerate(values)], "v double, load int, g int")
    want = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
    parts = df.groupBy("g", "load").agg(sum_parts("v").alias("p"))
    got = {r.g: (r.s, r.a) for r in parts.groupBy("g").agg(merged_parts("p").alias("p")).select("g", parts_sum("p").alias("s"), parts_avg("p").alias("a")).collect()}
    assert got == want
    odd = spark.createDataFrame([(1e300, 0), (-1e300, 1), (None, 2)], "v double, load int")
    merged = odd.groupBy("load").agg(sum_parts("v").alias("p")).agg(merged_parts("p").alias("p")).select(parts_sum("p").alias("s"))
    assert merged.first().s == 0.0
    none = odd.where("v is null").agg(sum_parts("v").alias("p")).select(parts_sum("p").alias("s"), parts_avg("p").alias("a"))
    assert none.first() == (None, None)
    most = (1 << 63) / 1e4 * 0.9  # two sums whose total leaves 64 bits
    over = spark.createDataFrame([(8e11, 0)] * 1000 + [(8e11, 1)] * 1000, "v double, load int")
    assert over.groupBy("load").agg(sum_parts("v").alias("p")).agg(merged_parts("p").alias("p")).select(parts_sum("p").alias("s")).first().s == 1.6e15 > most


def test_percentiles_from_merged_counts(spark):
    rng = np.random.default_rng(1)
    groups = {"cents": np.round(rng.lognormal(2, 1, 5000), 2), "wide": rng.normal(0, 1, 3000) * 10.0 ** rng.integers(-8, 12, 3000), "one": np.full(4000, 3.5),
              "edge": np.array([4095.99, 4096.0, -4096.0, -4095.99, -1e308, 1e308]), "two": np.array([1.0, 2.0])}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [(None, 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("load", F.pmod(F.xxhash64("v"), F.lit(4)))
    shares = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)
    partials = value_counts(df, {"load": F.col("load"), "g": F.col("g")}, [F.col("v")]).drop("load")
    got = {r.g: tuple(r)[1:] for r in percentiles_from_counts(partials, ["g"], {f"p{k}": (0, p) for k, p in enumerate(shares)}).collect()}
    for g, x in groups.items():
        assert np.allclose(got[g], np.quantile(x, shares), rtol=1e-12), g
    assert got[None] == (5.0,) * len(shares) and "none" not in got
    ordered = spark.createDataFrame([(float(v),) for v in sorted(np.r_[groups["wide"], groups["edge"], float("inf"), -float("inf"), np.linspace(-5000, 5000, 4001)])], "v double")
    found = [r.r for r in ordered.coalesce(1).select(value_range(F.col("v")).alias("r")).collect()]
    assert found == sorted(found)


def test_percentiles_read_the_rows_once(spark, scratch):
    spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.01).alias("v")).write.parquet(f"{scratch}/rows")
    df = spark.read.parquet(f"{scratch}/rows")
    query = percentiles_from_counts(value_counts(df, {"g": F.col("g")}, [F.col("v")]), ["g"], {"m": (0, 0.5)})
    query.collect()
    plan = query._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 or "ReusedExchange" in plan


def test_distinct_counts_from_bitmaps(spark):
    rows = [(n % 4, v) for n, v in enumerate([1, 2, 2, 32768, 32769, -1, 0, None, 10**12, 10**12, 3, 3])]
    df = spark.createDataFrame(rows, "load int, v long")
    merged = bitmap_partials(df, {"a": F.col("v"), "b": F.col("v") * 0}, ["load"]).drop("load")
    assert distinct_from_bitmaps(merged, ["a", "b", "c"]).first() == (8, 1, 0)
    assert distinct_from_bitmaps(bitmap_partials(df.limit(0), {"a": F.col("v")}), ["a"]).first() == (0,)


def test_pages_by_cursor_are_the_pages_by_offset(spark, store):
    t = from_store(spark, store)
    for flag_type in (None, "HIGH_SPEED"):
        after, seen = None, 0
        for offset in range(0, 200, 40):
            want = [r.err_id for r in anomalies.anomaly_list(t, 40, offset, flag_type)[0].collect()]
            page = anomalies.anomaly_page(t, 40, after, flag_type).collect()
            assert [r.err_id for r in page] == want
            seen += len(page)
            if not page:
                break
            after = page[-1].cursor
        assert seen >= 40
    last = anomalies.anomaly_list(t, 200, 0)[1].first().total
    end = anomalies.anomaly_list(t, 5, last - 5)[0].collect()
    cursor = anomalies.anomaly_page(t, 200, None).collect()[-1].cursor
    assert len(end) == 5 and read_cursor(cursor)[1] > 0
    with pytest.raises(ValueError):
        anomalies.anomaly_page(t, 10, "bm90IGpzb24=")


def test_a_page_reads_one_stretch_of_the_log(spark, scratch):
    """A log in many files: deep in the list the scan is bounded on both sides."""
    from meterline.operators.paging import in_ranges, page_index
    from meterline.plans.tables import Tables
    log = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("err_id"), F.col("id").alias("row_num"), F.lit("HIGH_SPEED").alias("err_type"),
                                     F.lit('{"fare":1.5}').alias("details"), F.lit("{}").alias("raw_data"), F.lit("2019-01-01 00:00:00").cast("timestamp").alias("created_at"), F.lit("anomaly").alias("source"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        in_ranges(log).repartitionByRange(40, F.col("row_num").desc()).sortWithinPartitions(F.col("row_num").desc()).write.parquet(f"{scratch}/log")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    errors = spark.read.parquet(f"{scratch}/log")
    index = page_index(errors).cache()
    assert index.count() == 40
    t = Tables(error_log=errors, partials={"flag_pages": index})
    first = anomalies.anomaly_page(t, 100).collect()
    assert [r.row_num for r in first] == list(range(19_999, 19_899, -1))
    place = read_cursor(first[-1].cursor)
    deep = (place[0], 10_000, "HIGH_SPEED", "anomaly")
    for start in (place, deep):
        end = page_end(index, 100, start, None)
        assert start[1] - 100 >= end[1] > start[1] - 2500  # a few files' rows, wherever the page lies
    page = anomalies.anomaly_page(t, 100, first[-1].cursor)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "row_num" in plan.split("PushedFilters")[1][:600] and [r.row_num for r in page.collect()] == list(range(19_899, 19_799, -1))


def test_files_to_store_in_one_call(spark, scratch):
    import os
    raw, zones, features = fixture_inputs(spark, SF_SMALL)
    columns = [c for c in raw.columns if c != "row_num"]
    raw.orderBy("row_num").select(*columns).coalesce(2).write.option("header", True).csv(f"{scratch}/trips")
    renamed = zones.select(F.col("id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"), "service_zone")
    renamed.coalesce(1).write.option("header", True).csv(f"{scratch}/zones")
    renamed.limit(0).coalesce(1).write.option("header", True).csv(f"{scratch}/no_zones")
    features.write.json(f"{scratch}/polygons")
    load_files(spark, f"{scratch}/store", f"{scratch}/trips", f"{scratch}/zones", f"{scratch}/polygons", load_id="a")
    t = from_store(spark, f"{scratch}/store")
    want = load(raw, zones).summary.first()
    assert t.trips.count() == want.inserted and stats.zone_stats(t).where("has_shape").count() > 0
    # the next load brings no zones of its own: those stored before count
    load_files(spark, f"{scratch}/store", f"{scratch}/trips", f"{scratch}/no_zones", load_id="b")
    assert from_store(spark, f"{scratch}/store").trips.count() == 2 * want.inserted
    assert [n for _, _, names in os.walk(f"{scratch}/store/_staged") for n in names] == []


def test_numbers_of_the_list_come_from_the_variant(spark, store):
    from meterline.operators.errorlog import VARIANT, json_extract_num
    t = from_store(spark, store)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    page = anomalies.anomaly_list(t, 200)[0]
    schema = page._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert f"{VARIANT}:struct<0:double,1:double>" in schema and "raw_data" not in schema
    stored = spark.read.parquet(f"{store}/error_log")
    each = stored.select(*[F.try_variant_get(VARIANT, f"$.{k}", "double").eqNullSafe(json_extract_num(F.col("details"), k)).alias(k) for k in ("fare", "distance")])
    assert each.where("fare and distance").count() == stored.count() > 0
