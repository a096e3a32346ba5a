"""Hand-made rows (one per flag code and per quirk): each case changes only what is listed."""
import pytest
from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.plans.pipeline import load

BASE = {
    "VendorID": "1", "tpep_pickup_datetime": "2019-01-01 00:46:40", "tpep_dropoff_datetime": "2019-01-01 00:53:20",
    "passenger_count": "1", "trip_distance": "1.50", "RatecodeID": "1", "store_and_fwd_flag": "N",
    "PULocationID": "151", "DOLocationID": "239", "payment_type": "1", "fare_amount": "7.00", "extra": "0.5",
    "mta_tax": "0.5", "tip_amount": "1.65", "tolls_amount": "0", "improvement_surcharge": "0.3",
    "total_amount": "9.95", "congestion_surcharge": "",
}

# name -> (changes, expected status, expected sorted flag codes incl. post flags once)
CASES = {
    "clean": ({}, "kept", []),
    "bad_pickup": ({"tpep_pickup_datetime": "not-a-date"}, "excluded", ["BAD_DATETIME"]),
    "bad_dropoff": ({"tpep_dropoff_datetime": ""}, "excluded", ["BAD_DATETIME"]),
    "equal_times": ({"tpep_dropoff_datetime": "@pickup"}, "excluded", ["DROPOFF_BEFORE_PICKUP"]),
    "excluded_soft": ({"tpep_dropoff_datetime": "@pickup-60", "passenger_count": "0"}, "excluded",
                      ["DROPOFF_BEFORE_PICKUP", "ZERO_PASS"]),
    "passengers_0": ({"passenger_count": "0"}, "kept", ["ZERO_PASS"]),
    "passengers_8": ({"passenger_count": "8"}, "kept", []),
    "passengers_9": ({"passenger_count": "9"}, "kept", ["HIGH_PASS"]),
    "passengers_blank": ({"passenger_count": ""}, "kept", []),
    "distance_0": ({"trip_distance": "0"}, "kept", ["ZERO_DIST", "ZERO_DIST_POS_FARE"]),
    "distance_bad": ({"trip_distance": "abc"}, "kept", ["ZERO_DIST_POS_FARE"]),
    "distance_100": ({"trip_distance": "100", "tpep_dropoff_datetime": "@pickup+36000"}, "kept", []),
    "distance_100_01": ({"trip_distance": "100.01", "tpep_dropoff_datetime": "@pickup+36000"}, "kept", ["LARGE_DIST"]),
    "neg_fare": ({"fare_amount": "-7"}, "kept", ["NEG_FARE"]),
    "neg_total": ({"total_amount": "-9.95"}, "kept", ["NEG_TOTAL"]),
    "neg_tip": ({"tip_amount": "-1"}, "kept", ["NEG_TIP"]),
    "rate_99": ({"RatecodeID": "99"}, "kept", ["BAD_RATE_CODE"]),
    "rate_blank": ({"RatecodeID": ""}, "kept", ["BAD_RATE_CODE"]),
    "speed_80": ({"trip_distance": "80", "tpep_dropoff_datetime": "@pickup+3600"}, "kept", []),
    "speed_above": ({"trip_distance": "80.01", "tpep_dropoff_datetime": "@pickup+3600"}, "kept", ["HIGH_SPEED"]),
    "tip_100": ({"tip_amount": "7.00"}, "kept", []),
    "tip_above": ({"tip_amount": "7.01"}, "kept", ["HIGH_TIP_PCT"]),
    "vendor_0": ({"VendorID": "0"}, "kept", []),
    "payment_0": ({"payment_type": "0"}, "kept", []),
    "zone_0": ({"DOLocationID": "0"}, "kept", []),
    "zone_orphan": ({"PULocationID": "999"}, "quarantine", []),
    "int_with_point": ({"passenger_count": "1.0"}, "kept", []),
}


def _rows():
    import datetime as dt
    rows, names = [], []
    for i, (name, (changes, _, _)) in enumerate(CASES.items(), start=1):
        shift = dt.timedelta(days=i)   # distinct keys: whole days per case
        pu = dt.datetime(2019, 1, 1, 0, 46, 40) + shift
        row = dict(BASE)
        row["tpep_pickup_datetime"] = pu.strftime("%Y-%m-%d %H:%M:%S")
        row["tpep_dropoff_datetime"] = (dt.datetime(2019, 1, 1, 0, 53, 20) + shift).strftime("%Y-%m-%d %H:%M:%S")
        for k, v in changes.items():
            if v.startswith("@pickup"):
                off = int(v[len("@pickup"):] or 0)
                v = (pu + dt.timedelta(seconds=off)).strftime("%Y-%m-%d %H:%M:%S")
            row[k] = v
        rows.append((i, *[row[c] for c in RAW_TRIP_COLUMNS]))
        names.append(name)
    # an exact duplicate of "clean" (same key), later row, passengers 9
    dup = dict(zip(RAW_TRIP_COLUMNS, rows[0][1:]))
    dup["passenger_count"] = "9"
    rows.append((1000, *[dup[c] for c in RAW_TRIP_COLUMNS]))
    return rows, names


@pytest.fixture(scope="module")
def loaded(spark):
    rows, names = _rows()
    raw = spark.createDataFrame(rows, "row_num long, " + ", ".join(f"{c} string" for c in RAW_TRIP_COLUMNS))
    zones = spark.createDataFrame([(151, "Manhattan", "Manhattan Valley", "Yellow Zone"),
                                   (239, "Manhattan", "Upper West Side South", "Yellow Zone")],
                                  "id int, borough string, zone_name string, service_zone string")
    return load(raw, zones), names


def test_cases(loaded):
    L, names = loaded
    kept = {r.row_num for r in L.trips.select("row_num").collect()}
    quarantine = {r.row_num for r in L.quarantine.select("row_num").collect()}
    excluded = {r.row_num for r in L.norm.where(F.col("hard_code").isNotNull()).select("row_num").collect()}
    flags = {}
    for r in L.error_log.where(F.col("source") == "quality").select("row_num", "err_type").collect():
        flags.setdefault(r.row_num, []).append(r.err_type)
    for i, name in enumerate(names, start=1):
        _, status, expected = CASES[name]
        got_status = "kept" if i in kept else "quarantine" if i in quarantine else "excluded" if i in excluded else "?"
        assert got_status == status, name
        assert sorted(flags.get(i, [])) == sorted(expected), name


def test_duplicate_logged_not_kept(loaded):
    L, _ = loaded
    assert L.trips.where("row_num = 1000").count() == 0
    types = [r.err_type for r in L.error_log.where("row_num = 1000").collect()]
    assert types == ["HIGH_PASS"]   # soft flags are logged for duplicates too


def test_post_flags_written_twice(loaded):
    L, names = loaded
    i = names.index("speed_above") + 1
    rows = L.error_log.where(F.col("row_num") == i).select("source", "details").collect()
    assert sorted(r.source for r in rows) == ["anomaly", "quality"]
    anomaly = [r.details for r in rows if r.source == "anomaly"][0]
    assert '"speed_mph":80.01' in anomaly and '"tip_pct"' in anomaly


def test_features_and_nulls(loaded):
    L, names = loaded
    t = {r.row_num: r for r in L.trips.collect()}
    clean = t[names.index("clean") + 1]
    assert clean.duration_min == 6.67 and clean.tip_pct == 23.57 and clean.cost_per_mile == 6.6333
    d0 = t[names.index("distance_0") + 1]
    assert d0.speed_mph is None and d0.cost_per_mile is None
    assert t[names.index("neg_fare") + 1].tip_pct is None
    assert t[names.index("neg_tip") + 1].tip_pct == -14.29
    assert t[names.index("neg_total") + 1].money_per_min < 0
    assert t[names.index("vendor_0") + 1].vendor is None
    assert t[names.index("payment_0") + 1].payment_type is None
    assert t[names.index("zone_0") + 1].dropoff_zone is None
    assert t[names.index("passengers_blank") + 1].passengers is None
    assert t[names.index("int_with_point") + 1].passengers == 1


def test_summary_balances(loaded):
    L, names = loaded
    s = L.summary.first()
    assert s.total_raw_rows == len(names) + 1
    assert s.excluded + s.duplicates + s.flagged + s.clean == s.total_raw_rows
    assert s.duplicates == 1 and s.quarantined == 1
