import math

from pyspark.sql import functions as F

from meterline.functions.geo import lcc_inverse
from meterline.operators.geo import ensure_multipolygon, to_wkt


def test_probe_points(spark):
    df = spark.createDataFrame([(984250.0, 0.0), (1000000.0, 200000.0)], "x double, y double")
    lon, lat = lcc_inverse(F.col("x"), F.col("y"))
    got = df.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert math.isclose(got[0].lon, -74.0, abs_tol=1e-9) and math.isclose(got[0].lat, 40.1666667, abs_tol=1e-7)
    assert math.isclose(got[1].lon, -73.943185, abs_tol=1e-6) and math.isclose(got[1].lat, 40.715616, abs_tol=1e-6)


def test_polygon_to_multipolygon_wkt(spark):
    df = spark.createDataFrame([("Polygon", "[[[1,2],[3,4],[5,6],[1,2]]]"),
                                ("MultiPolygon", "[[[[1,2],[3,4],[1,2]]],[[[7,8],[9,10],[7,8]]]]"),
                                ("Point", "[1,2]")], "t string, c string")
    got = [r[0] for r in df.select(to_wkt(ensure_multipolygon(F.col("t"), F.col("c")))).collect()]
    assert got == ["MULTIPOLYGON(((1 2, 3 4, 5 6, 1 2)))",
                   "MULTIPOLYGON(((1 2, 3 4, 1 2)), ((7 8, 9 10, 7 8)))", None]
