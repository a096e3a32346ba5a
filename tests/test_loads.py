"""Loads side by side, reruns, numbering of any frame, exact sums and percentiles, size checks."""

import os

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.functions.rounding import exact_avg, exact_sum
from meterline.operators.aggs import with_percentiles
from meterline.operators.geo import zone_shapes
from meterline.operators.joins import sized_broadcast
from meterline.operators.sinks import write_loaded, zones_if_absent
from meterline.operators.sorting import clamp_limit, stable_sort
from meterline.plans.pipeline import load
from meterline.plans.tables import fixture_inputs, from_store
from meterline.session import read_version, shared_dir
from meterline.sources.csv import number_rows, scan_trips_csv, scan_zones_csv
from tests.conftest import SF_SMALL


def _counts(spark, root):
    names = ("trips", "error_log", "quarantine", "load_summary", "zones")
    return {n: spark.read.parquet(f"{root}/{n}").count() for n in names} | {"hourly_stats": read_version(spark, root, "hourly_stats").count()}


def test_loads_keep_each_other_and_reruns_change_nothing(spark, scratch):
    raw, zones, features = fixture_inputs(spark, SF_SMALL)
    root = f"file://{scratch}/store"
    parts = [raw.where(F.pmod("row_num", F.lit(2)) == n) for n in range(2)]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    alone = [load(p, zones).summary.first() for p in parts]
    write_loaded(load(parts[0], zones), zones.where("id < 10"), root, zone_shapes(features), load_id="a")
    first = _counts(spark, root)
    write_loaded(load(parts[1], zones), zones, root, zone_shapes(features), load_id="b")
    both = _counts(spark, root)
    assert both["trips"] > first["trips"] and both["load_summary"] == 2 and both["zones"] == zones.count()
    assert spark.read.parquet(f"{root}/trips").where("load_id = 'b'").count() == alone[1].inserted
    write_loaded(load(parts[1], zones), zones, root, zone_shapes(features), load_id="b")
    assert _counts(spark, root) == both
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert not os.path.exists(f"{scratch}/store/_staged/load_id=a")
    trips = spark.read.parquet(f"{root}/trips")
    assert trips.where("created_at is null").count() == 0 and {r.load_id for r in trips.select("load_id").distinct().collect()} == {"a", "a~b", "b"}  # rows of a that waited for zones of b
    assert read_version(spark, root, "zone_stats").where("has_shape").count() > 0
    assert from_store(spark, root).zone_shapes is not None


def test_first_zone_in_file_order_wins(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n7,Z first,a,b\n7,A second,a,b\n")
    assert zones_if_absent(scan_zones_csv(spark, path, numbered=True), None).first().borough == "Z first"


def test_numbers_of_a_sorted_frame_with_payload(spark):
    rows = spark.range(0, 40_000, 1, 7).select(F.col("id").alias("row_num"), (F.col("id") * 7919 % 101).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    got = stable_sort(rows, [F.col("k").asc()], position="position")
    want = F.row_number().over(Window.orderBy("k", "row_num"))
    assert got.withColumn("want", want).where("position <> want").count() == 0
    assert got.select("position").distinct().count() == 40_000
    assert number_rows(rows.limit(0)).count() == 0


def test_csv_with_another_header_order_is_refused(spark, scratch):
    raw, _, _ = fixture_inputs(spark, SF_SMALL)
    columns = [c for c in raw.columns if c != "row_num"]
    few = raw.limit(50).cache()
    few.select(*columns).coalesce(1).write.option("header", True).csv(f"{scratch}/in")
    few.select(*columns[::-1]).coalesce(1).write.mode("append").option("header", True).csv(f"{scratch}/in")
    with pytest.raises(Exception, match="(?i)header|schema"):
        scan_trips_csv(spark, f"{scratch}/in", numbered=False).collect()


def test_sums_keep_their_digits(spark):
    df = spark.createDataFrame([(0.00004,)] * 1000 + [(None,)], "v double")
    assert df.agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first() == (0.04, 0.00004)
    big = spark.createDataFrame([(1e16,), (1e300,), (-1e300,)], "v double")
    assert big.agg(exact_sum("v").alias("s")).first().s in (0.0, 1e16)
    assert spark.createDataFrame([(1e16,), (0.25,)], "v double").agg(exact_sum("v").alias("s")).first().s == 1e16
    assert df.where("v is null").agg(exact_sum("v").alias("s")).first().s is None


def test_percentiles_of_a_hot_group(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.lognormal(2, 1, 30_000), 4)
    rows = [("hot", float(v)) for v in values] + [("two", 1.0), ("two", 2.0), (None, 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    grouped = df.groupBy("g").agg(F.count("*").alias("n"))
    out = with_percentiles(grouped, df, {"g": F.col("g")}, {"p0": (F.col("v"), 0.0), "p50": (F.col("v"), 0.5), "p90": (F.col("v"), 0.9), "p100": (F.col("v"), 1.0)})
    assert "percentile(" not in out._jdf.queryExecution().toString()
    got = {r.g: (r.p0, r.p50, r.p90, r.p100) for r in out.collect()}
    assert np.allclose(got["hot"], np.quantile(values, [0, 0.5, 0.9, 1]))
    assert np.allclose(got["two"], (1, 1.5, 1.9, 2)) and got[None] == (5.0,) * 4 and got["none"] == (None,) * 4


def test_broadcast_follows_the_size_on_disk(spark, scratch):
    path = f"{scratch}/dim"
    hinted = lambda df: "broadcast" in sized_broadcast(df, 4_000)._jdf.queryExecution().logical().toString().lower()
    spark.range(10).write.parquet(path)
    assert hinted(spark.read.parquet(path))
    spark.range(100_000).write.mode("overwrite").parquet(path)
    assert not hinted(spark.read.parquet(path))


def test_limits():
    assert [clamp_limit(v, 20, 100) for v in ("15abc", " 7", "x", None, 0, 5000, "3.9")] == [15, 7, 20, 20, 20, 100, 3]
    with pytest.raises(ValueError):
        clamp_limit("-4", 20, 100)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
