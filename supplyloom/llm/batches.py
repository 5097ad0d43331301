"""Sizes of the Arrow batches that go to Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows and bytes of a batch. The defaults (10,000 rows, 64 MB) make batches of texts so large that the copies on both
#: sides of a worker outgrow small executors.
ROWS, BYTES = 2000, 8 << 20
CONF = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Keeps this session's Arrow batches small. Plans read the setting when they run, so it stays."""
    for name, most in zip(CONF, (ROWS, BYTES)):
        spark.conf.set(name, str(most))
