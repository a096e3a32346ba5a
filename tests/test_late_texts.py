"""Texts of flags are made late, once and by generated code; timestamps by a cast where it means the same."""

from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.functions.parsing import parse_timestamp
from meterline.operators.normalise import normalise
from meterline.operators.paging import in_ranges
from meterline.plans.anomalies import anomaly_list
from meterline.plans.pipeline import load
from meterline.plans.tables import Tables

AT = "2019-02-01 00:00:00"


def _raw(spark):
    base = dict.fromkeys(RAW_TRIP_COLUMNS, "1") | {"tpep_pickup_datetime": "2019-01-01 08:00:00", "tpep_dropoff_datetime": "2019-01-01 08:30:00"}
    rows = [base, base | {"tpep_pickup_datetime": "x"}, base | {"trip_distance": "0", "passenger_count": "9", "total_amount": "8"}, base | {"trip_distance": "90", "total_amount": "7"},
            base | {"RatecodeID": "", "fare_amount": "-2.5"}]
    names = ("row_num", *RAW_TRIP_COLUMNS)
    return spark.createDataFrame([(i, *[r[c] for c in RAW_TRIP_COLUMNS]) for i, r in enumerate(rows, 1)], ", ".join(f"{n} {'bigint' if n == 'row_num' else 'string'}" for n in names))


def _zones(spark):
    return spark.createDataFrame([(1, "B", "Z", "S")], "id int, borough string, zone_name string, service_zone string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flags_of_a_row_come_from_generated_code(spark):
    norm = normalise(_raw(spark))
    found = {r.row_num: [f.err_type for f in r.raw_flags] for r in norm.collect()}
    assert found == {1: [], 2: ["BAD_DATETIME"], 3: ["HIGH_PASS", "ZERO_DIST"], 4: [], 5: ["NEG_FARE", "BAD_RATE_CODE"]}
    assert "lambda" not in _plan(norm)
    assert "lambda" not in _plan(load(_raw(spark), _zones(spark)).kept)


def test_a_plain_timestamp_is_cast_and_means_what_the_format_means(spark):
    texts = ["2019-01-31 23:59:59", "2019-02-30 00:00:00", "2020-02-29 00:00:00", "0000-01-01 00:00:00", "2019-01-01 24:00:00", "2019-01-01 00:60:00", "2019-1-01 00:00:00",
             "2019-01-01 00:00:0Z", "2019-01-01T00:00:00", " 2019-01-01 00:00:00", "2019-01-01 00:00:00\n", "2019-01-01 00:00:00.5", "2019-01-01", "+12019-01-01 00:00:00", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumns({"a": parse_timestamp("t"), "b": F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss"))})
    wrong = [r.t for r in df.select("t", F.unix_micros("a").alias("a"), F.unix_micros("b").alias("b")).collect() if r.a != r.b]
    assert not wrong
    assert "RLIKE" in _plan(df.select("a"))


def test_a_page_finishes_only_its_own_rows(spark):
    t = Tables(zones=_zones(spark), loaded=load(_raw(spark), _zones(spark), created_at=AT))
    page, _ = anomaly_list(t, 3)
    plan = _plan(page)
    assert [(r.row_num, r.err_type) for r in page.collect()] == [(5, "BAD_RATE_CODE"), (5, "NEG_FARE"), (4, "HIGH_SPEED")]
    assert "sha2" in plan.split("TakeOrderedAndProject")[0]
    assert "sha2" not in plan.split("TakeOrderedAndProject")[1]


def test_the_ranges_of_a_log_are_found_from_unfinished_rows(spark):
    loaded = load(_raw(spark), _zones(spark), created_at=AT)
    ranges = in_ranges(loaded.flag_rows)
    assert "sha2" not in _plan(ranges) and "to_json" not in _plan(ranges) and "structstojson" not in _plan(ranges).lower()
    records = sorted((r.row_num, r.err_type, r.source, r.raw_data != "{}") for r in loaded.error_log.collect())
    assert records == [(2, "BAD_DATETIME", "quality", False), (3, "HIGH_PASS", "quality", False), (3, "ZERO_DIST", "quality", False), (3, "ZERO_DIST_POS_FARE", "anomaly", True),
                       (3, "ZERO_DIST_POS_FARE", "quality", False), (4, "HIGH_SPEED", "anomaly", True), (4, "HIGH_SPEED", "quality", False), (5, "BAD_RATE_CODE", "quality", False),
                       (5, "NEG_FARE", "quality", False)]
