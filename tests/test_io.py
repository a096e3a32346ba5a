"""Sources and sinks: CSV round trip with contiguous row numbers, zone CSV, streaming = batch."""
import os

from pyspark.sql import functions as F

from meterline.config import RAW_TRIP_COLUMNS
from meterline.operators.sinks import zones_if_absent
from meterline.plans.pipeline import load
from meterline.plans.tables import fixture_inputs
from meterline.sources.csv import scan_trips_csv, scan_zones_csv
from meterline.streaming.ingest import stream_fixture_trips
from tests.conftest import SF_SMALL


def test_csv_scan_numbers_rows_contiguously(spark, scratch):
    raw, _, _ = fixture_inputs(spark, SF_SMALL)
    path = os.path.join(scratch, "trips_csv")
    raw.orderBy("row_num").select(*RAW_TRIP_COLUMNS).repartition(1).write.option("header", True).csv(path)
    scanned = scan_trips_csv(spark, path)
    n = raw.count()
    agg = scanned.agg(F.min("row_num"), F.max("row_num"), F.count_distinct("row_num")).first()
    assert tuple(agg) == (1, n, n)
    # same loader result as from the in-memory fixture (keys differ, counts do not)
    a = load(scanned, fixture_inputs(spark, SF_SMALL)[1]).summary.first()
    b = load(raw, fixture_inputs(spark, SF_SMALL)[1]).summary.first()
    assert (a.excluded, a.duplicates, a.flagged, a.clean) == (b.excluded, b.duplicates, b.flagged, b.clean)


def test_zone_csv_keeps_na_and_first_wins(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n"1","EWR","Newark Airport","EWR"\n\n'
                '"264","Unknown","NV","N/A"\n"265","","Outside of NYC","N/A"\n')
    zones = scan_zones_csv(spark, path)
    rows = {r.id: r for r in zones.collect()}
    assert rows[264].service_zone == "N/A" and rows[265].borough is None and len(rows) == 3
    existing = spark.createDataFrame([(1, "X", "Y", "Z")], zones.schema)
    merged = {r.id: r.borough for r in zones_if_absent(zones, existing).collect()}
    assert merged == {1: "X", 264: "Unknown", 265: None}


def test_stream_equals_batch(spark):
    raw, zones, _ = fixture_inputs(spark, SF_SMALL)
    batch = load(raw, zones).trips
    streamed = stream_fixture_trips(spark, SF_SMALL)
    cols = ["row_num", "vendor", "total", "tip_pct", "money_per_min"]
    assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, streamed.select(cols).collect()))


def test_csv_stream_numbers_rows_across_batches(spark, scratch):
    from meterline.streaming.ingest import start_ingest, trips_csv_stream
    raw, zones, _ = fixture_inputs(spark, SF_SMALL)
    src = os.path.join(scratch, "incoming")
    ordered = raw.orderBy("row_num").select(*RAW_TRIP_COLUMNS)
    ordered.repartition(3).write.option("header", True).csv(src)
    out = os.path.join(scratch, "stream_out")
    q = start_ingest(trips_csv_stream(spark, src, 1), zones, out)
    q.awaitTermination()
    assert q.exception() is None
    summary = spark.read.parquet(os.path.join(out, "load_summary"))
    assert summary.select("epoch").distinct().count() == 3
    n = raw.count()
    assert summary.agg(F.sum("total_raw_rows")).first()[0] == n
    trips = spark.read.parquet(os.path.join(out, "trips"))
    assert trips.agg(F.max("row_num")).first()[0] <= n and trips.select("row_num").distinct().count() == trips.count()
    batch = load(scan_trips_csv(spark, src), zones).summary.first()
    # the dedup outcome depends only on the rows, not on how they were numbered or batched
    assert trips.count() == batch.inserted


def test_trip_files_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    from meterline.config import RAW_TRIP_COLUMNS
    from meterline.plans import registry
    from meterline.sources.csv import scan_trips_csv

    numbers = [*range(300, 0, -1), 7, 7]
    raw = spark.createDataFrame([(n, *[str(n)] * len(RAW_TRIP_COLUMNS)) for n in numbers], "row_num long, " + ", ".join(f"{c} string" for c in RAW_TRIP_COLUMNS))
    raw.coalesce(1).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    monkeypatch.setattr(registry, "_FILE_BYTES", 2_000, raising=False)
    registry._write_trips_csv(raw, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("part-*"))) > 4
    back = scan_trips_csv(spark, str(tmp_path / "csv"))
    assert [r.VendorID for r in back.orderBy("row_num").collect()] == [str(n) for n in sorted(numbers)]
    assert sorted(r.row_num for r in back.collect()) == list(range(1, len(numbers) + 1))
