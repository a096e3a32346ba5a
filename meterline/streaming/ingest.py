"""Streaming load in three hops, each a Structured Streaming query with a checkpoint of its own:

* ``rows``: raw files → normalised rows, once per micro-batch. Writes the quality flags and, for ``trips``, the first
  occurrence of each trip key of the batch. A row whose pickup lies more than the allowed lateness before the newest
  pickup of *earlier* batches goes to the table ``late`` instead.
* ``trips``: keep-first over the whole stream in Spark's keyed state (RocksDB): per trip key the arrival of the first row
  and when it came; the rows themselves are read from the arrivals of the batch, which have one row per key. A watermark on the pickup time, as late as ``late`` is, evicts keys. Writes trips, quarantine and anomaly flags.
* ``hours``: windowed aggregation of the trips' exact partial sums, with a watermark too. Writes the windows that changed.

Hops hand over folders that get their final name in one step, so the next query sees whole batches only, and the queries
after the first delete what they have read. A trip key holds the pickup time, so a repeated row behind the watermark is
late itself: it can't be taken for a new trip when its key has gone from the state.

What a batch needs of the past is the running totals of the batch before it (one row under ``progress``), never a list of
all batches. Every output is written under the number of its batch and replaces only that, so a replayed batch writes the
same rows again; totals are counted from written rows and built on the batch before, so a replay doesn't count twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MAX_SPEED_MPH, MAX_TIP_PERCENTAGE, RAW_TRIP_COLUMNS, TIMESTAMP_FORMATS
from ..operators.dedup import TRIP_KEY
from ..operators.errorlog import post_rows, quality_rows
from ..operators.features import ENRICHED, enrich
from ..operators.joins import mark_orphans
from ..operators.normalise import normalise
from ..plans.pipeline import TRIP_COLUMNS, first_occurrences, with_candidates
from ..plans.stats import HOUR_KEYS, HOUR_METRICS, hourly_from, hourly_partials, merged
from ..session import STAGED, child_names, commit_folder, ensure_conf, join_path, make_dirs, path_exists, remove_path, shared_dir
from ..sources.csv import number_rows
from ..sources.fixtures import raw_trips_from_lineitem, zones_from_nation
from ..sources.tables import read_table

#: How far a pickup may lie before the newest one and still be taken.
LATENESS = "31 days"
#: Versions of changed windows that are kept before they are written as one.
COMPACT_AFTER = 32
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_QUERIES = ("rows", "trips", "hours")


def _write(df: DataFrame, root: str, table: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(join_path(root, table, f"epoch={epoch}"))


def _numbers(spark: SparkSession, root: str, table: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in child_names(spark, join_path(root, table)) if n.startswith("epoch="))


def _totals(spark: SparkSession, root: str, query: str, epoch: int | None = None) -> dict:
    """Running totals up to and with batch ``epoch`` (default: the last one); empty before the first."""
    table = f"progress/{query}"
    if epoch is None:
        epoch = max(_numbers(spark, root, table), default=-1)
    if epoch < 0:
        return {}
    return spark.read.parquet(join_path(root, table, f"epoch={epoch}")).first().asDict()


def _advance(spark: SparkSession, root: str, query: str, epoch: int, before: dict, counted: DataFrame) -> None:
    """Write the totals with this batch's counts (one row). Numbers are added, times give the latest. The totals of the
    batch before stay, for a replay of this one; older ones go."""
    row = counted.first().asDict()
    new = {k: (max(filter(None, (v, before.get(k))), default=None) if k.endswith("_time") else (v or 0) + before.get(k, 0)) for k, v in row.items()}
    schema = ", ".join(f"{k} {'timestamp' if k.endswith('_time') else 'bigint'}" for k in new)
    _write(spark.createDataFrame([tuple(new.values())], schema).coalesce(1), root, f"progress/{query}", epoch)
    for old in _numbers(spark, root, f"progress/{query}"):
        if old < epoch - 1:
            remove_path(spark, join_path(root, f"progress/{query}", f"epoch={old}"))


def _hand_over(df: DataFrame, root: str, table: str, epoch: int) -> None:
    """Write a folder that the next query reads, unless an earlier attempt of this batch has."""
    spark, path = df.sparkSession, join_path(root, table, f"batch-{epoch}")
    if path_exists(spark, path):
        return
    staged = join_path(root, "_staged", f"{table}-{epoch}")
    df.write.mode("overwrite").options(**STAGED).parquet(staged)
    commit_folder(spark, staged, path)


class Ingest:
    """The streaming load of one store. ``lateness`` is an interval text; the load's parameters are those of ``load``."""

    def __init__(self, raw_stream: DataFrame, zones: DataFrame, root: str, checkpoint: str | None = None, lateness: str = LATENESS, created_at=None,
                 timestamp_formats=TIMESTAMP_FORMATS, max_speed: float = MAX_SPEED_MPH, max_tip_pct: float = MAX_TIP_PERCENTAGE):
        self.spark, self.raw, self.zones, self.root, self.lateness = raw_stream.sparkSession, raw_stream, zones, root, lateness
        self.checkpoint, self.created_at = checkpoint or join_path(root, "_checkpoint"), created_at
        self.formats, self.params = timestamp_formats, (max_speed, max_tip_pct)
        self.queries: list = []
        for folder in ("candidates", "hour_parts"):
            make_dirs(self.spark, join_path(root, folder))

    def _started(self, stream: DataFrame, name: str, body: Callable[[DataFrame, int], None], trigger: dict, mode: str = "append"):
        def batch(df: DataFrame, epoch: int) -> None:
            body(df, epoch)
            remove_path(df.sparkSession, join_path(self.root, "_staged", f"{name}-{epoch}"))

        own = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
        before = {k: self.spark.conf.get(k, None) for k in own}
        try:  # a query keeps the settings it starts with
            for k, v in own.items():
                self.spark.conf.set(k, v)
            return (stream.writeStream.queryName(f"ingest-{name}-{uuid.uuid4().hex[:8]}").outputMode(mode).foreachBatch(batch)
                    .option("checkpointLocation", join_path(self.checkpoint, name)).trigger(**trigger).start())
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    # rows ---------------------------------------------------------------------------------------------------------

    def _rows(self, trigger: dict):
        observed = self.raw.observe("ingest_counters", F.count(F.lit(1)).alias("rows"))  # shown in lastProgress
        return self._started(observed, "rows", self._rows_batch, trigger)

    def _rows_batch(self, batch: DataFrame, epoch: int) -> None:
        spark, staging = batch.sparkSession, join_path(self.root, "_staged", f"rows-{epoch}")
        before = _totals(spark, self.root, "rows", epoch - 1)
        if "row_num" not in batch.columns:  # numbers go on after the rows of earlier batches, in file order
            batch = number_rows(batch, file_order=True, path=staging).withColumn("row_num", F.col("row_num") + F.lit(before.get("total_raw_rows", 0)))
        norm = with_candidates(normalise(batch, self.formats), self.params).drop(*ENRICHED)  # made again for the rows that stay
        newest = before.get("newest_pickup_time")
        oldest = F.lit(None).cast("timestamp") if newest is None else F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {self.lateness}")
        norm = norm.withColumn("late", F.col("hard_code").isNull() & F.coalesce(F.col("pickup_time") < oldest, F.lit(False)))
        norm.write.mode("overwrite").options(**STAGED).parquet(f"{staging}/norm")  # the only read of the input
        norm = spark.read.schema(norm.schema).parquet(f"{staging}/norm")
        first = first_occurrences(norm.where(~F.col("late")).drop("late"), self.params).withColumn("arrival", F.lit(epoch).cast("bigint"))
        _hand_over(first, self.root, "candidates", epoch)
        _write(quality_rows(norm, "raw_flags", self.created_at), self.root, "error_log/step=rows", epoch)
        if newest is not None:
            _write(enrich(norm.where("late")).select(*TRIP_COLUMNS), self.root, "late", epoch)
        counted = norm.agg(F.count(F.lit(1)).alias("total_raw_rows"), F.count_if(F.col("hard_code").isNotNull()).alias("excluded"), F.count_if("late").alias("late"),
                           F.max(F.when(F.col("hard_code").isNull(), F.col("pickup_time"))).alias("newest_pickup_time"))
        _write(counted.drop("newest_pickup_time"), self.root, "load_summary", epoch)
        _advance(spark, self.root, "rows", epoch, before, counted)

    # trips --------------------------------------------------------------------------------------------------------

    def _candidates_schema(self):
        raw = self.spark.createDataFrame([], "row_num bigint, " + ", ".join(f"`{c}` string" for c in RAW_TRIP_COLUMNS))
        rows = with_candidates(normalise(raw, self.formats), self.params).drop(*ENRICHED)
        return first_occurrences(rows, self.params).withColumn("arrival", F.lit(0).cast("bigint")).schema

    def _trips(self, trigger: dict):
        stream = self.spark.readStream.schema(self._candidates_schema()).option("recursiveFileLookup", True).option("cleanSource", "delete").parquet(join_path(self.root, "candidates"))
        # one second more than the rule for late rows, so that no row is dropped here that was let in there
        rows = stream.withWatermark("pickup_time", f"{self.lateness} 1 second").withColumn("_ml_now", F.current_timestamp())
        keyed = rows.groupBy(*TRIP_KEY).agg(F.min("arrival").alias("arrival"), F.min("_ml_now").alias("born"), F.max("_ml_now").alias("touched"))
        first = F.struct(*TRIP_KEY, "arrival").alias("first")
        return self._started(keyed.select(first, "born", "touched"), "trips", self._trips_batch, trigger, "update")

    def _first_rows(self, keys: DataFrame) -> DataFrame:
        """The candidates of ``keys`` (trip key and arrival). An arrival has one candidate of a key. Only the folders of these
        arrivals are opened: older ones may be on their way out."""
        spark, schema = keys.sparkSession, self._candidates_schema()
        folders = [join_path(self.root, "candidates", f"batch-{r.arrival}") for r in keys.select("arrival").distinct().collect()]
        found = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
        keys = keys.withColumnsRenamed({c: f"_ml_{c}" for c in keys.columns})
        # the parts that are never null are compared plainly, the most distinct first: the sides mostly sort by that one alone
        never_null = ("pickup_time", "dropoff_time", "total", "arrival")
        same = [F.col(c) == F.col(f"_ml_{c}") for c in never_null] + [F.col(c).eqNullSafe(F.col(f"_ml_{c}")) for c in TRIP_KEY if c not in never_null]
        return found.join(keys, same, "left_semi").drop("arrival")

    def _trips_batch(self, batch: DataFrame, epoch: int) -> None:
        spark, staged = batch.sparkSession, join_path(self.root, "_staged", f"trips-{epoch}")
        before = _totals(spark, self.root, "trips", epoch - 1)
        # all keys that this batch touched; new are those whose first row came in this batch
        keys = batch.where(F.col("born") == F.col("touched")).select(*[f"first.{c}" for c in (*TRIP_KEY, "arrival")])
        keys.write.mode("overwrite").options(**STAGED).parquet(f"{staged}/keys")  # the only run of the state
        staging = f"{staged}/kept"
        new = enrich(mark_orphans(self._first_rows(spark.read.schema(keys.schema).parquet(f"{staged}/keys")), self.zones))
        new.write.mode("overwrite").options(**STAGED).parquet(staging)
        kept = spark.read.schema(new.schema).parquet(staging)
        trips = kept.where(~F.col("orphan")).select(*TRIP_COLUMNS)
        _write(trips, self.root, "trips", epoch)
        _write(kept.where("orphan").select(*TRIP_COLUMNS), self.root, "quarantine", epoch)
        _write(post_rows(kept, self.created_at), self.root, "error_log/step=trips", epoch)
        _hand_over(hourly_partials(trips), self.root, "hour_parts", epoch)
        counted = kept.agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.size("post_flags") > 0).alias("flagged"), F.count_if(~F.col("orphan")).alias("inserted"))
        _advance(spark, self.root, "trips", epoch, before, counted)

    # hours --------------------------------------------------------------------------------------------------------

    def _hours(self, trigger: dict):
        schema = hourly_partials(self.spark.createDataFrame([], "pickup_time timestamp, hour_of_day int, " + ", ".join(f"{m} double" for m in HOUR_METRICS))).schema
        parts = self.spark.readStream.schema(schema).option("recursiveFileLookup", True).option("cleanSource", "delete").parquet(join_path(self.root, "hour_parts"))
        window = F.window("hour_block_ts", "1 hour")
        hours = merged([window.alias("w"), F.col("hour_of_day")], HOUR_METRICS, parts.withWatermark("hour_block_ts", f"{self.lateness} 2 hours"))
        return self._started(hours, "hours", self._hours_batch, trigger, "update")

    def _hours_batch(self, batch: DataFrame, epoch: int) -> None:
        spark, table = batch.sparkSession, "hour_windows"
        _write(batch.select(F.col("w.start").alias("hour_block_ts"), *[c for c in batch.columns if c != "w"]), self.root, table, epoch)
        held = [n for n in _numbers(spark, self.root, table) if n <= epoch]
        if len(held) > COMPACT_AFTER:  # all windows as of this batch, in its place
            staged = join_path(self.root, "_staged", f"hours-{epoch}")
            hour_windows(spark, self.root).write.mode("overwrite").parquet(staged)
            _write(spark.read.parquet(staged), self.root, table, epoch)
            for old in held[:-1]:
                remove_path(spark, join_path(self.root, table, f"epoch={old}"))

    # ---------------------------------------------------------------------------------------------------------------

    def run(self) -> "Ingest":
        """Take in what has arrived, hop after hop; returns when all is written, and raises what ended a query."""
        for start in (self._rows, self._trips, self._hours):
            query = start({"availableNow": True})
            self.queries.append(query)
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
        return self

    def start(self, processing_time: str = "30 seconds") -> "Ingest":
        """All three queries side by side, until stopped."""
        self.queries = [start({"processingTime": processing_time}) for start in (self._rows, self._trips, self._hours)]
        return self

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def awaitTermination(self) -> None:  # noqa: N802  like StreamingQuery
        for query in self.queries:
            query.awaitTermination()

    def exception(self):
        return next((e for q in self.queries if (e := q.exception()) is not None), None)


def start_ingest(raw_stream: DataFrame, zones: DataFrame, root: str, checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, load_options: dict | None = None, lateness: str = LATENESS) -> Ingest:
    """The streaming load: what has arrived so far (``available_now``; returns when it is written), or until stopped.
    ``load_options`` are the run parameters of ``load``."""
    ingest = Ingest(raw_stream, zones, root, checkpoint, lateness, **(load_options or {}))
    return ingest.run() if available_now else ingest.start(processing_time or "30 seconds")


def hour_windows(spark: SparkSession, root: str) -> DataFrame:
    """The exact partial sums of every hour so far: each window as of the last batch that changed it."""
    versions = spark.read.parquet(join_path(root, "hour_windows"))
    values = F.struct("n", *HOUR_METRICS)
    return versions.groupBy(*HOUR_KEYS).agg(F.max_by(values, "epoch").alias("v")).select(*HOUR_KEYS, "v.*")


def stream_hourly_stats(spark: SparkSession, root: str) -> DataFrame:
    return hourly_from(hour_windows(spark, root))


def stream_summary(spark: SparkSession, root: str) -> DataFrame:
    """The counters of a streaming load so far (one row), from the last totals only."""
    rows, trips = _totals(spark, root, "rows"), _totals(spark, root, "trips")
    epochs = max(_numbers(spark, root, "progress/rows"), default=-1) + 1
    raw, excluded, late, kept = rows.get("total_raw_rows", 0), rows.get("excluded", 0), rows.get("late", 0), trips.get("kept", 0)
    flagged, inserted = trips.get("flagged", 0), trips.get("inserted", 0)
    names = ("epochs", "total_raw_rows", "excluded", "late", "duplicates", "flagged", "clean", "inserted", "quarantined")
    return spark.createDataFrame([(epochs, raw, excluded, late, raw - excluded - late - kept, flagged, kept - flagged, inserted, kept - inserted)], ", ".join(f"{n} bigint" for n in names))


def trips_csv_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming reader of a directory of trip CSV files (header, trimmed, empty fields as ''). A file whose header
    doesn't name these columns in this order ends the stream with an error; nothing is read by position alone."""
    schema = ", ".join(f"`{c}` string" for c in RAW_TRIP_COLUMNS)
    stream = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).csv(path))
    return stream.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in RAW_TRIP_COLUMNS])


def stream_arrivals(spark: SparkSession, arrivals: list[DataFrame], zones: DataFrame, root: str | None = None, lateness: str = LATENESS) -> str:
    """Stream raw rows through the ingest, one arrival after the other, each in one micro-batch; returns the output root."""
    root = root or join_path(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    files = join_path(shared_dir(spark), f"stream-files-{uuid.uuid4().hex}")
    for rows in arrivals:
        rows.write.mode("append").parquet(files)
        start_ingest(spark.readStream.schema(rows.schema).parquet(files), zones, root, lateness=lateness)
    remove_path(spark, files)
    return root


def fixture_arrivals(spark: SparkSession, sf_dir: str, by: str) -> tuple[list[DataFrame], DataFrame]:
    """The lineitem-derived fixture in four arrivals by a column, and its zones."""
    ensure_conf(spark)
    raw = raw_trips_from_lineitem(read_table(spark, sf_dir, "lineitem"))
    zones = zones_from_nation(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
    value = F.col(by) if by == "row_num" else F.unix_timestamp(F.to_timestamp(F.coalesce(F.try_to_timestamp(by), F.lit("2019-01-01 00:00:00"))))
    cuts = raw.select(value.cast("double").alias("v")).approxQuantile("v", [0.25, 0.5, 0.75], 0.01)
    arrivals = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        arrived = raw if low is None else raw.where(value >= low)
        arrivals.append(arrived if high is None else arrived.where(value < high))
    return arrivals, zones


def stream_fixture(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Four arrivals in row order: pickups of all days in each, repeated keys in all of them."""
    return stream_arrivals(spark, *fixture_arrivals(spark, sf_dir, "row_num"), root=root)


def stream_redelivery(spark: SparkSession, sf_dir: str, root: str | None = None, lateness: str = "7 days") -> str:
    """Four arrivals in order of pickup, then all rows once more: those within the lateness are found in the state, the
    others are late."""
    arrivals, zones = fixture_arrivals(spark, sf_dir, "tpep_pickup_datetime")
    again = raw_trips_from_lineitem(read_table(spark, sf_dir, "lineitem"))
    return stream_arrivals(spark, [*arrivals, again], zones, root, lateness)


def stream_fixture_trips(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    return spark.read.parquet(join_path(stream_fixture(spark, sf_dir, root), "trips")).drop("epoch")
