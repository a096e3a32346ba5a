"""Writers. Every load writes its own ``load_id=...`` folder of each table, so loads stay side by side and a rerun of a
load replaces exactly what that load wrote, also after a lost executor or a failed job."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import child_names, free_shuffles, join_path, path_exists, remove_path
from .errorlog import error_rows, with_variant
from .joins import referential_check
from .paging import in_ranges, page_index


def load_path(root: str, name: str, load_id: str) -> str:
    return join_path(root, name, f"load_id={load_id}")


def write_trips(trips: DataFrame, root: str, load_id: str, created_at) -> str:
    """One load's trips by pickup day, with the time of the load. A rebalance on the day sizes the files: a day with a
    large share of all trips is split over many writers, small days share one."""
    path = load_path(root, "trips", load_id)
    (trips.withColumn("created_at", F.lit(created_at).cast("timestamp")).withColumn("pickup_date", F.to_date("pickup_time"))
          .hint("rebalance", F.col("pickup_date")).write.mode("overwrite").partitionBy("pickup_date").parquet(path))
    return path


def write_part(df: DataFrame, root: str, name: str, load_id: str) -> str:
    path = load_path(root, name, load_id)
    df.write.mode("overwrite").parquet(path)
    return path


def write_table(df: DataFrame, root: str, name: str) -> str:
    path = join_path(root, name)
    df.write.mode("overwrite").parquet(path)
    return path


def absent_zones(new: DataFrame, existing: DataFrame | None) -> DataFrame:
    """The rows of ``new`` to insert: ids not present yet. Of several new rows of an id the first in file order, if
    ``new`` carries ``row_num``, else the one that sorts first by its columns."""
    columns = [c for c in new.columns if c != "row_num"]
    rest = F.struct(*[F.col(c) for c in columns if c != "id"])
    pick = F.min_by(rest, F.col("row_num")) if "row_num" in new.columns else F.min(rest)
    first = new.groupBy("id").agg(pick.alias("_ml_z")).select("id", "_ml_z.*").select(*columns)
    return first if existing is None else first.join(existing.select("id"), "id", "left_anti").select(*columns)


def zones_if_absent(new: DataFrame, existing: DataFrame | None) -> DataFrame:
    """``existing`` and the zones of ``new`` that it lacks."""
    added = absent_zones(new, existing)
    return added if existing is None else existing.unionByName(added.select(*existing.columns))


def first_stored(zones: DataFrame) -> DataFrame:
    """Stored zones, one row per id: the one inserted first. Loads that run at once can both insert an id, as neither sees
    the other's; readers take the earlier insertion (of equal times, the load whose name sorts first)."""
    rest = [c for c in zones.columns if c not in ("id", "inserted_at", "load_id")]
    return zones.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("inserted_at", "load_id")).alias("_ml_z")).select("id", "_ml_z.*")


#: Joins the name of a load whose rows waited for a zone to that of the load that brought it.
WAITED = "~"


def waiting(spark, root: str) -> DataFrame | None:
    """Quarantined rows of all loads that no later load has taken in. None if nothing was ever quarantined."""
    if not path_exists(spark, join_path(root, "quarantine")):
        return None
    rows = spark.read.parquet(join_path(root, "quarantine"))
    taken = [n.partition("=")[2] for n in child_names(spark, join_path(root, "trips")) if WAITED in n]
    if not taken:
        return rows
    admitted = (spark.read.parquet(join_path(root, "trips")).where(F.col("load_id").isin(taken))
                .select(F.substring_index("load_id", WAITED, 1).alias("load_id"), "row_num"))
    return rows.join(admitted, ["load_id", "row_num"], "left_anti")


def readmit(spark, root: str, load_id: str, zones: DataFrame, added: DataFrame, created_at) -> list[str]:
    """Take in rows of other loads that waited for a zone which this load adds and whose references are all known now. They
    become trips under ``load_id=<their load>~<this load>`` with partials of their own, and leave the quarantine by that; a
    rerun of this load does the same again. Returns the names of the loads written."""
    rows = waiting(spark, root)
    if rows is None or added.isEmpty():
        return []
    new = added.select(F.col("id").alias("_ml_new"))
    either = F.array(F.col("pickup_zone"), F.col("dropoff_zone"))
    touched = rows.where(F.col("load_id") != load_id).withColumn("_ml_ref", F.explode(either)).join(new, F.col("_ml_ref") == F.col("_ml_new"), "left_semi")
    touched = touched.drop("_ml_ref").dropDuplicates(["load_id", "row_num"])
    valid, _ = referential_check(touched, zones)
    staged = load_path(root, "_staged", f"readmitted-{load_id}")
    valid.write.mode("overwrite").partitionBy("load_id").parquet(staged)
    names = [n.partition("=")[2] for n in child_names(spark, staged) if n.startswith("load_id=")]
    for name in names:
        write_trips(spark.read.schema(valid.drop("load_id").schema).parquet(f"{staged}/load_id={name}"), root, f"{name}{WAITED}{load_id}", created_at)
    remove_path(spark, staged)
    return [f"{name}{WAITED}{load_id}" for name in names]


def write_partials(root: str, load_id: str, trips: DataFrame, flags: DataFrame | None) -> dict:
    """Steps that write the partials of one load from its own trips and flags (none for rows that waited: they were flagged
    with their own load)."""
    from ..plans.rollups import TRIP_PARTIALS, flag_counts
    from ..plans.stats import hourly_partials

    made = {name: partial for name, partial in (*TRIP_PARTIALS.items(), ("hourly_partials", hourly_partials))}
    steps = {name: lambda name=name, partial=partial: write_part(partial(trips), root, name, load_id) for name, partial in made.items()}
    if flags is not None:
        steps["flag_counts"] = lambda: write_part(flag_counts(flags), root, "flag_counts", load_id)
        steps["flag_pages"] = lambda: write_part(page_index(flags).coalesce(1), root, "flag_pages", load_id)
    return steps


#: Jobs of a load that run side by side: each is small or leaves cores idle at its end.
_AT_ONCE = 4


def write_loaded(loaded, zones: DataFrame, root: str, zone_shapes: DataFrame | None = None,
                 timings: dict | None = None, load_id: str | None = None, read_once: str | None = None) -> dict:
    """Persist one load beside earlier ones: trips, quarantine, error_log, load_summary and the zones not stored yet, each
    under ``load_id`` (a new one by default; a given one replaces that load only). zone_shapes is replaced as a whole.
    Rows of other loads that waited for a zone of this one become trips. The load's partials are written from its own trips, the
    two summary tables are merged from the partials of all loads, and
    the load's staged tables removed. ``timings`` (optional dict) receives seconds per step. ``read_once`` is a folder that nothing
    reads but ``loaded``: it goes as soon as the load is staged."""
    from ..plans.stats import refresh_stats
    from ..plans.tables import PARTIALS, from_store

    spark = loaded.norm.sparkSession
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    created = loaded.created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    t = timings if timings is not None else {}

    def step(name, fn):
        t0 = time.time()
        result = fn()
        t[name] = round(time.time() - t0, 3)
        return result

    def together(steps: dict) -> dict:
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            running = {name: pool.submit(step, name, fn) for name, fn in steps.items()}
            return {name: job.result() for name, job in running.items()}

    def insert_zones():
        stored = None
        if path_exists(spark, join_path(root, "zones")):
            stored = spark.read.parquet(join_path(root, "zones")).where(F.col("load_id") != load_id)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        return write_part(absent_zones(zones, stored).withColumn("inserted_at", F.lit(now).cast("timestamp")), root, "zones", load_id)

    for table in ("trips", *PARTIALS):  # rows of this load that later loads took in are its own again
        for name in child_names(spark, join_path(root, table)):
            if name.startswith(f"load_id={load_id}{WAITED}"):
                remove_path(spark, join_path(root, table, name))

    staging = load_path(root, "_staged", load_id)
    loaded = step("stage", lambda: loaded.staged(staging, zones))
    loaded.created_at = created
    if read_once is not None:
        remove_path(spark, read_once)
    free_shuffles(spark)
    steps = {
        "trips": lambda: write_trips(loaded.trips, root, load_id, created),
        "error_log": lambda: write_part(with_variant(error_rows(in_ranges(loaded.flag_rows), created)), root, "error_log", load_id),
        "quarantine": lambda: write_part(loaded.quarantine, root, "quarantine", load_id),
        "zones": insert_zones,
        "load_summary": lambda: write_part(loaded.summary, root, "load_summary", load_id),
    }
    if zone_shapes is not None:
        steps["zone_shapes"] = lambda: write_table(zone_shapes, root, "zone_shapes")
    out = together(steps)
    free_shuffles(spark)
    flags = spark.read.parquet(out["error_log"])
    # from the staged trips, which stand in fewer files than those written by day
    out |= together(write_partials(root, load_id, loaded.trips, flags))
    zones_now = first_stored(spark.read.parquet(join_path(root, "zones")))
    for name in step("readmit", lambda: readmit(spark, root, load_id, zones_now, spark.read.parquet(out["zones"]), created)):
        together(write_partials(root, name, spark.read.parquet(load_path(root, "trips", name)), None))
    step("refresh_stats", lambda: refresh_stats(from_store(spark, root), root))
    out["hourly_stats"], out["zone_stats"] = join_path(root, "hourly_stats"), join_path(root, "zone_stats")
    remove_path(spark, staging)
    return out
