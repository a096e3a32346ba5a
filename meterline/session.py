"""Spark session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: wall-clock fields are read in UTC, ANSI arithmetic, adaptive execution.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot interprets methods beyond 8 KB of bytecode, row by row; wide projections are generated in smaller ones instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app_name: str = "meterline",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # generated code for wide projections exceeds HotSpot's 8 KB JIT limit; let it be compiled
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the queries depend on (UTC wall clock above all)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    This is whatever ``spark.checkpoint.dir`` names. A session on one machine without that setting gets a private
    folder; any other session must name one, because executors don't share local folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="meterline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


#: Write options of tables that are read back soon and then removed: a dictionary takes more time there than it saves, and zstd makes up for its room.
STAGED = {"compression": "zstd", "parquet.enable.dictionary": "false"}

def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended jobs removed now. They go when the driver's garbage collector finds them unused, which Spark
    itself sees to every 30 minutes only (``spark.cleaner.periodicGC.interval``); until then they stay on the executors' disks."""
    spark._jvm.System.gc()


def written(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """``df`` computed once, written to a folder of its own ``under`` that path (default: the shared folder) and read back."""
    path = join_path(under or shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.options(**STAGED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that holds ``path`` (any URI), not of the driver's disk."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of our own."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.mkdirs(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def commit_folder(spark: SparkSession, staged: str, path: str) -> bool:
    """Give a finished folder its final name in one step. False, and nothing changes, if that name is taken: the work was
    done before."""
    fs, where = _file_system(spark, path)
    if fs.exists(where):
        return False
    fs.mkdirs(where.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), where):
        raise OSError(f"{staged} can't be renamed to {path}")
    return True


#: A file in a table's folder that names the version to read.
_POINTER = "_CURRENT"
#: Versions that stay beside the current one, for readers that have opened them.
_OLD_VERSIONS = 1


def switch_version(spark: SparkSession, root: str, name: str, df: DataFrame) -> str:
    """Write ``df`` as a new version of a table, then point readers to it by replacing the pointer file in one step."""
    folder, version = join_path(root, name), f"v-{uuid.uuid4().hex}"
    before = current_version(spark, root, name)
    df.write.parquet(join_path(folder, version))
    jvm = spark._jvm
    fs, draft = _file_system(spark, join_path(folder, f"{_POINTER}.{version}"))
    out = fs.create(draft, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(join_path(folder, _POINTER))), options)
    aside = [(f.getModificationTime(), f.getPath()) for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder))
             if f.getPath().getName().startswith("v-") and f.getPath().getName() not in (version, before)]
    for _, old in sorted(aside, key=lambda x: x[0])[:max(0, len(aside) + 1 - _OLD_VERSIONS)]:
        fs.delete(old, True)
    return version


def current_version(spark: SparkSession, root: str, name: str) -> str | None:
    fs, where = _file_system(spark, join_path(root, name, _POINTER))
    if not fs.exists(where):
        return None
    pointer = fs.open(where)  # a name that readers of data skip
    try:
        return bytes(pointer.readAllBytes()).decode()
    finally:
        pointer.close()


def read_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a table that ``switch_version`` writes."""
    return spark.read.parquet(join_path(root, name, current_version(spark, root, name)))
