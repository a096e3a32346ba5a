"""Readers: trip CSV, zone lookup CSV, zone polygons (JSON rows), row numbering, and fixtures."""

from .csv import number_rows, scan_trips_csv, scan_zones_csv
from .fixtures import raw_trips_from_lineitem, zone_polygons_from_part, zones_from_nation
from .polygons import scan_zone_polygons
from .tables import read_table

__all__ = [
    "number_rows", "scan_trips_csv", "scan_zones_csv", "raw_trips_from_lineitem",
    "zone_polygons_from_part", "zones_from_nation", "scan_zone_polygons", "read_table",
]
