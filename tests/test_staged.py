"""What a load or a stream writes on its way: narrow rows, each folder as long as something reads it, numbers read by casts."""

import os

from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.functions.parsing import FLOAT_PREFIX, INT_PREFIX, parse_float, parse_int
from meterline.operators import sinks
from meterline.operators.features import ENRICHED
from meterline.plans import registry
from meterline.plans.files import load_files
from meterline.plans.pipeline import TRIP_COLUMNS, load
from meterline.streaming import ingest

BASE = dict(zip(RAW_TRIP_COLUMNS, [""] * len(RAW_TRIP_COLUMNS))) | {
    "VendorID": "1", "tpep_pickup_datetime": "2019-01-01 10:00:00", "tpep_dropoff_datetime": "2019-01-01 10:07:00", "passenger_count": "1", "trip_distance": "1.50",
    "PULocationID": "1", "DOLocationID": "2", "payment_type": "1", "fare_amount": "7.00", "tip_amount": "1.65", "total_amount": "9.95"}
# a repeat, a repeated and a null number, a hard exclusion, a null vendor, post flags, an unknown zone
ROWS = [(1, {}), (2, {}), (2, {"total_amount": "-3"}), (None, {"tip_amount": "70"}), (4, {"tpep_dropoff_datetime": "x"}), (5, {"VendorID": ""}), (6, {"trip_distance": "99"}),
        (7, {"PULocationID": "99"})]


def frames(spark, rows=ROWS):
    raw = spark.createDataFrame([(n, *[(BASE | other)[c] for c in RAW_TRIP_COLUMNS]) for n, other in rows], "row_num long, " + ", ".join(f"`{c}` string" for c in RAW_TRIP_COLUMNS))
    return raw, spark.createDataFrame([(1, "A", "a", "s"), (2, "B", "b", "s")], "id int, borough string, zone_name string, service_zone string")


def sorted_rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_numbers_by_cast_are_those_by_pattern(spark):
    texts = ["", " ", "1", "+5", "-5", "5 ", " 5", "\t7", "\x017", "7\x01", "\x7f5", "5\x7f", "1.5", "1.", ".5", ".", "1e5", "1.e5", "1e", "1d", "1.1f", "0x1p3", "0X1P3", "-0x1p3", "00x1", "NaN", "Infinity",
             "-Infinity", "inf", "1e400", "12abc", "9223372036854775807", "9223372036854775808", "1,000", "/5", "١", "-.5", "+", "--1", "-0", "1 2", "1\n", "1_0", "1L", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", parse_int("t").alias("i"), F.regexp_extract("t", INT_PREFIX, 1).try_cast("bigint").alias("by_pattern_i"),
        parse_float("t").alias("f"), F.regexp_extract("t", FLOAT_PREFIX, 1).try_cast("double").alias("by_pattern_f"))
    assert found.where("not (i <=> by_pattern_i and f <=> by_pattern_f)").collect() == []
    for parsed in (parse_int("t"), parse_float("t")):
        assert "cast" in str(parsed).split("regexp_extract")[0].lower()  # tried before the pattern


def test_staged_rows_hold_no_features_and_kept_ones_do(spark, scratch):
    raw, zones = frames(spark)
    lazy = load(raw, zones)
    staged = load(raw, zones).staged(f"{scratch}/s", zones)
    assert not set(ENRICHED) & set(spark.read.parquet(f"{scratch}/s/norm").columns)
    columns = (*TRIP_COLUMNS, "orphan", "post_flags")
    assert sorted_rows(staged.kept, *columns) == sorted_rows(lazy.kept, *columns)
    assert sorted_rows(staged.error_log.drop("created_at"), "*") == sorted_rows(lazy.error_log.drop("created_at"), "*")
    assert staged.summary.first() == lazy.summary.first()


def test_stream_hands_over_no_features_and_gives_the_trips_of_the_batch(spark, scratch, monkeypatch):
    handed = {}
    over = ingest._hand_over
    monkeypatch.setattr(ingest, "_hand_over", lambda df, root, table, epoch: (handed.setdefault(table, df.columns), over(df, root, table, epoch))[1])
    raw, zones = frames(spark)
    older = [(9, {"tpep_pickup_datetime": "2018-12-01 10:00:00", "tpep_dropoff_datetime": "2018-12-01 10:30:00"})]
    root = ingest.stream_arrivals(spark, [raw, frames(spark, older)[0]], zones, f"{scratch}/out", lateness="3 days")
    assert not set(ENRICHED) & set(handed["candidates"])
    assert sorted_rows(spark.read.parquet(f"{root}/trips"), *TRIP_COLUMNS) == sorted_rows(load(raw, zones).trips, *TRIP_COLUMNS)
    assert [(r.row_num, r.duration_min) for r in spark.read.parquet(f"{root}/late").collect()] == [(9, 30.0)]


def test_numbered_rows_go_when_they_are_staged(spark, scratch, monkeypatch):
    raw, zones = frames(spark)
    raw.write.parquet(f"{scratch}/raw")
    raw = spark.read.parquet(f"{scratch}/raw")
    registry._write_trips_csv(raw, f"{scratch}/trips")
    assert all(n.endswith(".csv.gz") for n in os.listdir(f"{scratch}/trips") if n.startswith("part-"))
    zones.select(F.col("id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"), "service_zone").coalesce(1).write.option("header", True).csv(f"{scratch}/zones")
    left = []
    monkeypatch.setattr(sinks, "free_shuffles", lambda spark: left.append(sorted(os.listdir(f"{scratch}/store/_staged"))))
    load_files(spark, f"{scratch}/store", f"{scratch}/trips", f"{scratch}/zones", load_id="a")
    # once the load is staged, only its own tables and the numbered zones are left
    assert "load_id=numbered-trips-a" not in left[0] and "load_id=a" in left[0]
    assert spark.read.parquet(f"{scratch}/store/trips").count() == load(raw, zones).trips.count()
