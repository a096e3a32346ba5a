"""Zone polygons: geometry parsing, Polygon → MultiPolygon, WKT text, reprojection, zone_shapes rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import reproject_multipolygon
from ..functions.parsing import js_number_text

POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"


def ensure_multipolygon(geom_type: Column, coords_json: Column) -> Column:
    """Parsed coordinates as a MultiPolygon; NULL for any other geometry type."""
    return (F.when(geom_type == "Polygon", F.array(F.from_json(coords_json, POLYGON)))
            .when(geom_type == "MultiPolygon", F.from_json(coords_json, MULTIPOLYGON)))


def _num(v: Column, digits: int | None) -> Column:
    return js_number_text(v) if digits is None else F.format_string(f"%.{digits}f", v)


def to_wkt(multi: Column, digits: int | None = None) -> Column:
    """``MULTIPOLYGON(((x y, x y, …)), …)``; ``digits`` fixes the decimals, else shortest number text."""
    def ring(r):
        return F.concat(F.lit("("), F.array_join(F.transform(
            r, lambda p: F.concat(_num(p.getItem(0), digits), F.lit(" "), _num(p.getItem(1), digits))), ", "), F.lit(")"))

    def poly(p):
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))

    # NULL geometry gives NULL text (concat / array_join propagate NULL); ``multi`` is referenced once
    return F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(multi, poly), ", "), F.lit(")"))


def shape_location_id(props: str = "properties") -> Column:
    """LocationID, else location_id, else OBJECTID (0 and missing are skipped, like ``a || b || c``)."""
    p = lambda c: F.col(f"{props}.{c}")
    return F.coalesce(F.nullif(p("LocationID"), F.lit(0)), F.nullif(p("location_id"), F.lit(0)), p("OBJECTID"))


def zone_shapes(features: DataFrame, web_digits: int | None = None) -> DataFrame:
    """One zone_shapes row per feature: location_id, area, len, geom (WKT, feet), geom_web (WKT, degrees),
    mappable, notes. Coordinates are written in full; ``web_digits`` fixes the decimals of geom_web, for comparisons.
    Unsupported geometry types give NULL WKT and ``mappable = false`` with a note."""
    multi = ensure_multipolygon(F.col("geometry.type"), F.col("geometry.coordinates"))
    staged = features.select(
        shape_location_id().cast("int").alias("location_id"),
        F.coalesce(F.nullif(F.col("properties.Shape_Area"), F.lit(0.0)), F.lit(0.0)).alias("area"),
        F.coalesce(F.nullif(F.col("properties.Shape_Leng"), F.lit(0.0)), F.lit(0.0)).alias("len"),
        F.col("geometry.type").alias("geom_type"), multi.alias("_multi"))
    ok = F.col("_multi").isNotNull()
    staged = staged.withColumn("_web", reproject_multipolygon(F.col("_multi")))
    return staged.select(
        "location_id", "area", "len",
        to_wkt(F.col("_multi")).alias("geom"),
        to_wkt(F.col("_web"), web_digits).alias("geom_web"),
        ok.alias("mappable"),
        F.when(~ok, F.concat(F.lit("unsupported geometry type: "), F.coalesce(F.col("geom_type"), F.lit("null"))))
         .alias("notes"))
