"""The table bundle every named query reads, and the ways to obtain it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.geo import zone_shapes
from ..operators.sinks import first_stored, waiting
from ..session import child_names, ensure_conf, join_path, path_exists
from ..sources.fixtures import raw_trips_from_lineitem, zone_polygons_from_part, zones_from_nation
from ..sources.tables import read_table
from .pipeline import Loaded, load


#: Time of the load in queries over the given tables, whose results must repeat.
FIXTURE_CREATED_AT = "2019-02-01 00:00:00"


class Tables:
    """trips, zones, error_log, zone_shapes (and the pipeline state when built from raw input).
    Members built from the pipeline are created on first use only."""

    def __init__(self, trips=None, zones=None, error_log=None, zone_shapes=None, loaded: Loaded | None = None,
                 features: DataFrame | None = None, partials: dict[str, DataFrame] | None = None):
        self._partials = partials or {}
        self._trips, self.zones, self._error_log, self._zone_shapes = trips, zones, error_log, zone_shapes
        self.loaded, self._features = loaded, features

    @property
    def trips(self) -> DataFrame:
        if self._trips is None:
            self._trips = self.loaded.trips
        return self._trips

    @property
    def quarantine(self) -> DataFrame:
        """Kept trips whose zone references aren't all known (yet)."""
        return self.loaded.quarantine

    def partials(self, name: str) -> DataFrame | None:
        """Stored partials of all loads, one set of rows per load; None if the store has none for some load."""
        return self._partials.get(name)

    @property
    def error_log(self) -> DataFrame:
        if self._error_log is None:
            self._error_log = self.loaded.error_log
        return self._error_log

    @property
    def zone_shapes(self) -> DataFrame | None:
        if self._zone_shapes is None and self._features is not None:
            self._zone_shapes = zone_shapes(self._features)
        return self._zone_shapes


def fixture_inputs(spark: SparkSession, sf_dir: str):
    """(raw_trips, zones, zone polygon features) derived from the given tables of ``sf_dir``."""
    ensure_conf(spark)
    raw = raw_trips_from_lineitem(read_table(spark, sf_dir, "lineitem", spread=True))
    zones = zones_from_nation(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
    features = zone_polygons_from_part(read_table(spark, sf_dir, "part", spread=True))
    return raw, zones, features


def from_testdata(spark: SparkSession, sf_dir: str) -> Tables:
    """Run the load pipeline over the fixture derived from ``sf_dir`` (lazily; Catalyst prunes what a query
    does not use)."""
    raw, zones, features = fixture_inputs(spark, sf_dir)
    return Tables(zones=zones, loaded=load(raw, zones, created_at=FIXTURE_CREATED_AT), features=features)


#: Tables of mergeable partials that every load writes from its own trips and flags (plans.rollups, plans.stats).
PARTIALS = ("hourly_partials", "trip_cube", "value_counts", "zone_bitmaps", "flag_counts", "flag_pages")


class StoredTables(Tables):
    """The tables of a store. Each is opened when a query first asks for it."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root, self._opened, self.loaded = spark, root, {}, None

    def _stored(self, name: str, made) -> DataFrame | None:
        if name not in self._opened:
            self._opened[name] = made(join_path(self._root, name))
        return self._opened[name]

    def _read(self, path: str) -> DataFrame | None:
        return self._spark.read.parquet(path) if path_exists(self._spark, path) else None

    def _loads(self, name: str) -> set[str]:
        return {n for n in child_names(self._spark, join_path(self._root, name)) if n.startswith("load_id=")}

    @property
    def trips(self) -> DataFrame:
        return self._stored("trips", self._read)

    @property
    def error_log(self) -> DataFrame:
        return self._stored("error_log", self._read)

    @property
    def zones(self) -> DataFrame:
        return self._stored("zones", lambda path: first_stored(self._read(path)))

    @property
    def zone_shapes(self) -> DataFrame | None:
        return self._stored("zone_shapes", self._read)

    @property
    def quarantine(self) -> DataFrame | None:
        return self._stored("quarantine", lambda path: waiting(self._spark, self._root))

    def partials(self, name: str) -> DataFrame | None:
        """Only if every load has written some; rows that waited have no flags of their own."""
        def whole(path: str) -> DataFrame | None:
            loads = self._loads("error_log" if name.startswith("flag_") else "trips")
            return self._read(path) if loads and self._loads(name) == loads else None
        return self._stored(name, whole)


def from_store(spark: SparkSession, root: str) -> Tables:
    """Tables previously written by ``operators.sinks.write_loaded`` under ``root``."""
    ensure_conf(spark)
    return StoredTables(spark, root)
