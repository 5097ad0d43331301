"""Working tables that cut lineage between the stages of a longer job.

They live below ``spark.checkpoint.dir``, the folder all executors share, so a
lost executor costs a re-read and not a recomputation. Written as Parquet they
also stay column-pruned, and their row count is observed while they are written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CONF = "spark.checkpoint.dir"
#: Narrow rows that are worth a task and a file of their own.
ROWS_EACH = 1 << 15
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    app = spark.sparkContext.applicationId
    shared = spark.conf.get(CONF, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CONF} to a folder that all executors can reach")
        shared = _local_roots.setdefault(app, tempfile.mkdtemp(prefix="supplyloom-"))
    return f"{shared.rstrip('/')}/supplyloom-{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.partitionBy(partition_by) if partition_by else counted.write
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written = True
    return with_known_rows(table, seen.get["rows"])


def packed(df: DataFrame, rows: int, each: int = ROWS_EACH) -> DataFrame:
    """``df`` of ``rows`` rows at most in no more partitions than they are worth, but one for each core at least.

    A shuffle deals even a short table out to all its partitions; each would be a task and a file.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` itself when ``materialise`` returned it, else a written copy."""
    return df if getattr(df, "written", False) else materialise(df, label)


def with_known_rows(df: DataFrame, rows: int) -> DataFrame:
    df.known_rows = rows
    return df


def rows_of(df: DataFrame) -> int:
    """Row count; no job when it was observed on the way."""
    known = getattr(df, "known_rows", None)
    return df.count() if known is None else known


def clear_scratch(spark: SparkSession) -> None:
    """Drop this application's working tables. Frames that read them become invalid."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
