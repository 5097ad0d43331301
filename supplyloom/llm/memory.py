"""Memory that executors keep between the stages of a longer job, given back.

A heap that one stage made large stays so for the next one, and a Python worker that serves several stages keeps what
each remembered (the tokenizer and its tables) and the pages that numpy and Arrow freed. Together they outgrow an
executor that has room for every stage alone.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Tasks for each core, so that all executors and their idle workers get some.
TASKS_EACH = 2
#: The module whose functions remember, from task to task of a worker. A worker that never loaded it need not.
REMEMBERS = "supplyloom.llm.tokens"


def forget(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, after this process gave up what it can make again."""
    if REMEMBERS in sys.modules:
        sys.modules[REMEMBERS].encoder_of.cache_clear()
        sys.modules[REMEMBERS]._powers.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
    yield from batches


def release_executors(spark: SparkSession) -> None:
    """A short job after which executors hold little more than what is in use: workers forget, then the heap shrinks.

    An executor that gets no task of it stays as it is.
    """
    tasks = TASKS_EACH * spark.sparkContext.defaultParallelism
    forgot = spark.range(0, tasks, 1, tasks).mapInArrow(forget, "id long")
    forgot.select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()
