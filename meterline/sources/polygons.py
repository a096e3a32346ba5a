"""Zone polygons as JSON feature rows (one GeoJSON-like feature per line).

The binary shapefile codec of the reference is not rebuilt; features arrive as JSON rows and
``coordinates`` is kept as JSON text until its shape is known from ``geometry.type``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("location_id", T.IntegerType()),
        T.StructField("OBJECTID", T.IntegerType()),
        T.StructField("Shape_Area", T.DoubleType()),
        T.StructField("Shape_Leng", T.DoubleType()),
    ])),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),   # raw JSON, parsed per geometry type
    ])),
])


def scan_zone_polygons(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE_SCHEMA).option("mode", "PERMISSIVE").json(path)
