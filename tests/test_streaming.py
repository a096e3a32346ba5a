"""Streaming ingest: keep-first in Spark's state, late rows, exact windows, replays, what is left behind."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.plans import stats
from meterline.plans.pipeline import load
from meterline.plans.tables import Tables
from meterline.streaming.ingest import Ingest, hour_windows, stream_arrivals, stream_hourly_stats, stream_summary

BASE = dict(zip(RAW_TRIP_COLUMNS, [""] * len(RAW_TRIP_COLUMNS))) | {
    "VendorID": "1", "passenger_count": "1", "trip_distance": "1.50", "RatecodeID": "1", "store_and_fwd_flag": "N", "PULocationID": "1", "DOLocationID": "2",
    "payment_type": "1", "fare_amount": "7.00", "tip_amount": "1.65", "total_amount": "9.95"}


def trip(number, pickup, minutes=7, **other):
    hour, minute = int(pickup[11:13]), int(pickup[14:16]) + minutes
    dropoff = f"{pickup[:11]}{hour + minute // 60:02d}:{minute % 60:02d}:00"
    return {"row_num": number, **BASE, "tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff, **other}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in ("row_num", *RAW_TRIP_COLUMNS)) for r in rows], "row_num long, " + ", ".join(f"`{c}` string" for c in RAW_TRIP_COLUMNS))


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, "A", "a", "s"), (2, "B", "b", "s")], "id int, borough string, zone_name string, service_zone string")


def read(spark, root, table):
    return spark.read.parquet(f"{root}/{table}")


def test_repeated_and_late_rows(spark, zones, scratch):
    first = [trip(1, "2019-01-01 10:00:00"), trip(3, "2019-01-01 11:00:00"), trip(2, "2019-01-01 11:00:00", passenger_count="9"), trip(4, "not-a-date 00:00")]
    second = [trip(10, "2019-01-01 10:00:00"), trip(11, "2019-01-05 09:00:00"), trip(12, "2018-12-31 10:00:00")]
    third = [trip(20, "2019-01-01 10:00:00"), trip(21, "2019-01-05 09:00:00"), trip(22, "2019-01-04 09:00:00"), trip(23, "2019-01-02 09:00:00", PULocationID="99")]
    root = stream_arrivals(spark, [frame(spark, r) for r in (first, second, third)], zones, f"{scratch}/out", lateness="3 days")
    # 2 before 3 within a batch; 10 repeats 1 across batches; 12 is in time yet; 20 repeats a key that has gone from the state; 23 is neither late nor known
    assert sorted(r.row_num for r in read(spark, root, "trips").collect()) == [1, 2, 11, 12, 22]
    assert sorted(r.row_num for r in read(spark, root, "late").collect()) == [20]
    assert [r.row_num for r in read(spark, root, "quarantine").collect()] == [23]
    s = stream_summary(spark, root).first().asDict()
    assert s == {"epochs": 3, "total_raw_rows": 11, "excluded": 1, "late": 1, "duplicates": 3, "flagged": 0, "clean": 6, "inserted": 5, "quarantined": 1}
    errors = read(spark, root, "error_log")
    assert sorted((r.row_num, r.err_type) for r in errors.collect()) == [(2, "HIGH_PASS"), (4, "BAD_DATETIME")]


def test_hours_are_exact(spark, zones, scratch):
    totals = ["0.00001", "0.00001", "0.00004", "10.1234567", "1e16", "1e16", "-3.25", "7"]
    rows = [trip(n, f"2019-01-01 10:{n:02d}:00", total_amount=t, tip_amount=f"0.{n}234567") for n, t in enumerate(totals)]
    whole = frame(spark, rows)
    root = stream_arrivals(spark, [frame(spark, rows[:3]), frame(spark, rows[3:6]), frame(spark, rows[6:])], zones, f"{scratch}/out")
    batch = stats.hourly_stats(Tables(zones=zones, loaded=load(whole, zones)))
    assert stream_hourly_stats(spark, root).collect() == batch.collect() and batch.first().revenue > 2e16


def test_replayed_batches_change_nothing(spark, zones, scratch):
    arrivals = [frame(spark, [trip(1, "2019-01-01 10:00:00"), trip(2, "2019-01-01 10:00:00")]), frame(spark, [trip(3, "2019-01-02 10:00:00"), trip(4, "2019-01-01 10:00:00")])]
    root = stream_arrivals(spark, arrivals, zones, f"{scratch}/out")
    tables = ("trips", "quarantine", "late", "error_log", "load_summary")

    def state():
        return [sorted(map(repr, read(spark, root, t).collect())) for t in tables], stream_summary(spark, root).first(), sorted(map(repr, hour_windows(spark, root).collect()))

    before = state()
    os.makedirs(f"{scratch}/never")
    source = spark.readStream.schema(arrivals[0].schema).parquet(f"{scratch}/never")
    ingest = Ingest(source, zones, root)
    ingest._rows_batch(arrivals[1], 1)  # as after a driver that died before its commit
    assert state() == before
    batch = load(arrivals[1], zones).kept.where("row_num = 3").drop("orphan").withColumn("arrival", F.lit(1).cast("bigint"))
    keyed = batch.select(F.struct(*batch.columns).alias("first"), F.lit(1).alias("born"), F.lit(1).alias("touched"))
    ingest._trips_batch(keyed, 1)
    assert state() == before and spark.read.parquet(f"{root}/trips/epoch=1").count() == 1


def test_little_is_left_behind(spark, zones, scratch):
    arrivals = [frame(spark, [trip(10 * n + k, f"2019-01-{2 * n + 1:02d} 1{k}:00:00") for k in range(3)]) for n in range(4)]
    root = stream_arrivals(spark, arrivals, zones, f"{scratch}/out", lateness="1 day")
    assert read(spark, root, "trips").count() == 12
    assert [n for _, _, files in os.walk(f"{root}/_staged") for n in files] == []
    assert {q: len(os.listdir(f"{root}/progress/{q}")) for q in ("rows", "trips")} == {"rows": 2, "trips": 2}
    # candidates that were read are deleted with the next batch, so no more than the last ones stay
    assert len([d for d, _, files in os.walk(f"{root}/candidates") if any(n.endswith(".parquet") for n in files)]) <= 2


def test_keys_behind_the_watermark_leave_the_state(spark, zones, scratch):
    os.makedirs(f"{scratch}/in")
    for n in range(4):
        frame(spark, [trip(100 * n + k, f"2019-01-{3 * n + 1:02d} 10:{k:02d}:00") for k in range(20)]).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        source = spark.readStream.schema(frame(spark, []).schema).parquet(f"{scratch}/in")
        ingest = Ingest(source, zones, f"{scratch}/out", lateness="2 days").run()
        held = ingest.queries[1].lastProgress["stateOperators"][0]
        assert held["numRowsTotal"] <= 60 and "rocksdb" in str(held["customMetrics"]).lower()
    assert ingest.queries[1].lastProgress["stateOperators"][0]["numRowsTotal"] < 80
    assert read(spark, f"{scratch}/out", "trips").count() == 80


def test_windows_are_compacted(spark, zones, scratch, monkeypatch):
    from meterline.streaming import ingest
    monkeypatch.setattr(ingest, "COMPACT_AFTER", 2)
    arrivals = [frame(spark, [trip(n, f"2019-01-01 {10 + n % 2}:{n:02d}:00")]) for n in range(5)]
    root = stream_arrivals(spark, arrivals, zones, f"{scratch}/out")
    assert len(os.listdir(f"{root}/hour_windows")) <= 3
    assert sorted((r.hour_of_day, r.total_trips) for r in stream_hourly_stats(spark, root).collect()) == [(10, 3), (11, 2)]


def test_state_holds_no_whole_rows_and_first_rows_come_from_their_arrival(spark, tmp_path):
    from meterline.config import RAW_TRIP_COLUMNS
    from meterline.streaming.ingest import stream_arrivals

    def raw(*rows):
        base = dict(zip(RAW_TRIP_COLUMNS, [""] * len(RAW_TRIP_COLUMNS)))
        made = [{**base, "VendorID": v, "tpep_pickup_datetime": f"2019-01-01 10:0{m}:00", "tpep_dropoff_datetime": "2019-01-01 10:30:00", "PULocationID": "1", "DOLocationID": "1",
                 "total_amount": "9", "tip_amount": tip} for _, v, m, tip in rows]
        return spark.createDataFrame([(n, *[x[c] for c in RAW_TRIP_COLUMNS]) for (n, *_), x in zip(rows, made)], "row_num long, " + ", ".join(f"{c} string" for c in RAW_TRIP_COLUMNS))

    zones = spark.createDataFrame([(1, "B", "Z", "S")], "id int, borough string, zone_name string, service_zone string")
    # repeated and null row numbers, a null vendor in the key; the later arrival has the smaller number
    arrivals = [raw((5, "1", 1, "1"), (5, "1", 1, "1"), (6, "", 2, "2")), raw((1, "1", 1, "7"), (2, "", 2, "7"), (None, "2", 3, "3"), (None, "2", 3, "3"))]
    root = stream_arrivals(spark, arrivals, zones, str(tmp_path / "out"))
    trips = spark.read.parquet(f"{root}/trips").select("row_num", "tip").collect()
    assert sorted((str(r.row_num), r.tip) for r in trips) == [("5", 1.0), ("6", 2.0), ("None", 3.0)]
    state = spark.read.format("statestore").load(f"{root}/_checkpoint/trips")
    assert sorted(f.dataType.simpleString() for f in state.schema["value"].dataType) == ["bigint", "timestamp", "timestamp"]
