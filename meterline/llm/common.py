"""Small helpers shared by the corpus operators: table reads, the shared folder, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. A private folder is made only for
    a local session without that setting; any other session must name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="meterline-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: it is computed a single time, its
    lineage ends there, and a lost executor costs no more than one re-read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch that a Python worker gets at once. Spark's own limit counts rows, whatever the length of their texts.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python workers in batches of at most about BATCH_BYTES, for what the session runs from now on: a worker
    and its executor hold whole batches, in several forms, and keep that memory for the stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that ``df`` doesn't have in any case spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_crc(id_column: str) -> Column:
    """crc32 of the id as text, the split rule of the held-out rows; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary"))


def sample_rate(total: int, wanted: int) -> float:
    return 1.0 if total <= wanted else wanted / total


def hash_below(id_column: str, rate: float, salt: int) -> Column:
    """True for about ``rate`` of the ids, the same ones on every run."""
    return F.pmod(F.xxhash64(F.col(id_column), F.lit(salt)), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
