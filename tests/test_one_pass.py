"""Queries over a load that isn't stored go through its raw rows as few times as their inputs ask for."""
import datetime as dt

from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.plans import anomalies, client, overview
from meterline.plans.pipeline import load
from meterline.plans.rollups import flag_counts, flags
from meterline.plans.tables import Tables

PLAIN = {c: "" for c in RAW_TRIP_COLUMNS} | {
    "VendorID": "1", "tpep_pickup_datetime": "2019-01-01 00:46:40", "tpep_dropoff_datetime": "2019-01-01 00:53:20", "passenger_count": "1", "trip_distance": "1.50",
    "RatecodeID": "1", "PULocationID": "1", "DOLocationID": "2", "payment_type": "1", "fare_amount": "7.00", "tip_amount": "1.40", "total_amount": "9.95"}
ROWS = [
    (1, {}),
    (2, {}),  # a repeat of the first
    (3, {"trip_distance": "0", "tip_amount": "7.70", "payment_type": "2", "total_amount": "11"}),  # flagged raw and as a trip, twice
    (3, {"passenger_count": "0", "total_amount": "12"}),  # its number comes again
    (None, {"passenger_count": "9", "total_amount": "13"}),
    (None, {"RatecodeID": "99", "total_amount": "14", "PULocationID": "3"}),
    (6, {"PULocationID": "77", "fare_amount": "-7"}),  # no such zone
    (7, {"tpep_pickup_datetime": "x"}),
    (8, {"PULocationID": "264", "payment_type": "", "total_amount": "15", "tip_amount": "0"}),
    (9, {"PULocationID": "", "total_amount": "16", "payment_type": "2", "tip_amount": "0.70"}),
]


def _tables(spark, rows=ROWS, repeat_zone=False):
    data = [(n, *[(PLAIN | changes)[c] for c in RAW_TRIP_COLUMNS]) for n, changes in rows]
    raw = spark.createDataFrame(data, "row_num long, " + ", ".join(f"{c} string" for c in RAW_TRIP_COLUMNS))
    known = [(1, "A", "a", "x"), (2, "B", "b", "x"), (3, "B", "c", "x"), (264, "Unknown", "u", "x")] + [(1, "A", "a", "x")] * repeat_zone
    zones = spark.createDataFrame(known, "id int, borough string, zone_name string, service_zone string")
    return Tables(zones=zones, loaded=load(raw, zones, created_at=dt.datetime(2019, 2, 1)))


def _raw_scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("LogicalRDD" in line and "row_num" in line for line in plan.splitlines())


def test_flags_are_counted_as_from_the_log(spark):
    for rows in (ROWS, ROWS[:1], []):
        t = _tables(spark, rows)
        key = lambda r: (r["err_type"] or "", r["count"])
        assert sorted(map(key, flags(t).collect())) == sorted(map(key, flag_counts(t.error_log).collect()))
        assert _raw_scans(flags(t)) == 2  # before: 4


def test_summary_and_kpis(spark):
    t = _tables(spark)
    found = anomalies.summary(t).first()
    # ZERO_DIST, ZERO_PASS, HIGH_PASS, BAD_RATE_CODE, NEG_FARE and two records each of HIGH_TIP_PCT and ZERO_DIST_POS_FARE; rows 3, null and 6
    assert tuple(found) == (9, 3, 42.86)
    types = anomalies.summary_with_types(t).first()
    assert tuple(types)[:3] == tuple(found)
    assert [tuple(x) for x in types["by_type"]] == [(r["count"], r["err_type"]) for r in flags(t).where("err_type is not null").orderBy(F.desc("count"), F.desc("err_type")).collect()]
    kpis = overview.overview_kpis(t)
    assert kpis.select("total_trips", "total_revenue", "unique_pickup_zones", "unique_dropoff_zones", "flag_rows").first() == (7, 90.95, 3, 1, 3)
    assert kpis.columns[-3:] == ["unique_pickup_zones", "unique_dropoff_zones", "flag_rows"]
    assert _raw_scans(anomalies.summary(t)) == 2 and _raw_scans(anomalies.summary_with_types(t)) == 2 and _raw_scans(kpis) == 3  # before: 5, 7 and 7
    empty = _tables(spark, [])
    assert tuple(anomalies.summary(empty).first()) == (0, 0, 0.0)
    assert overview.overview_kpis(empty).select("total_trips", "unique_pickup_zones", "flag_rows").first() == (0, 0, 0)


def test_tip_split_reads_trips_once(spark):
    for repeat in (False, True):  # a zone that stands twice counts its trips twice for its borough, not for a payment type
        t = _tables(spark, repeat_zone=repeat)
        split = client.tip_payment_split(t)
        assert _raw_scans(split) == 1  # before: 4
        # tips of 20, 20, 20, 20 % by card (of no type: 0 %), 110 and 10 % by cash; borough A: 110, 20, 20, 20; B: 20
        assert sorted(map(tuple, split.collect())) == [("A", 21.25, 63.75), ("B", 10.0, 30.0)]


def test_second_page_reads_the_written_list(spark):
    from meterline.plans.registry import _second_page

    t = _tables(spark, [(n or 5, changes) for n, changes in ROWS])
    for flag_type in (None, "ZERO_PASS"):
        once = anomalies.with_written_list(t, flag_type)
        page = anomalies.anomaly_page(once, 4, None, flag_type)
        assert _raw_scans(page) == 0 and page.collect() == anomalies.anomaly_page(t, 4, None, flag_type).collect()
    assert _raw_scans(_second_page(t)) == 0  # before: 2
