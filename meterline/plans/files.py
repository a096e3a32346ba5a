"""One call from files to a store."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..operators.geo import zone_shapes
from ..operators.sinks import first_stored, load_path, write_loaded, zones_if_absent
from ..session import ensure_conf, join_path, path_exists, remove_path
from ..sources.csv import scan_trips_csv, scan_zones_csv
from ..sources.polygons import scan_zone_polygons
from .pipeline import load


def load_files(spark: SparkSession, root: str, trips_csv: str, zones_csv: str, polygons_json: str | None = None, load_id: str | None = None,
               created_at=None, timings: dict | None = None, **options) -> dict:
    """Load trip, zone and (if given) polygon files into the store at ``root``, as one load. References are checked against the
    zones of the file and those stored before. ``options`` are those of ``load``. What is written on the way is removed."""
    ensure_conf(spark)
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    numbered = load_path(root, "_staged", f"numbered-{load_id}")
    new = scan_zones_csv(spark, zones_csv, numbered=True, path=numbered)
    stored = first_stored(spark.read.parquet(join_path(root, "zones"))) if path_exists(spark, join_path(root, "zones")) else None
    zones = zones_if_absent(new, stored)
    trips = load_path(root, "_staged", f"numbered-trips-{load_id}")
    raw = scan_trips_csv(spark, trips_csv, path=trips)
    shapes = zone_shapes(scan_zone_polygons(spark, polygons_json)) if polygons_json else None
    out = write_loaded(load(raw, zones, created_at=created_at, **options), zones, root, shapes, timings, load_id, read_once=trips)
    remove_path(spark, numbered)
    return out
