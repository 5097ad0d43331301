"""The two stateless refinement streams and continuous scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyloom.operators.refine import MIN_CONFIDENCE, refined, to_silver
from supplyloom.operators.scoring import score_relations
from supplyloom.sources.landing import landing_schema, read_landing
from supplyloom.sources.schemas import BRONZE, CORRUPT, as_landed, typed, with_corrupt_column
from supplyloom.sources.tables import read_path
from supplyloom.streaming.monitor import BatchMetrics


def append_available(
    stream: DataFrame, path: str, checkpoint: str, timeout: float | None = None, watch: BatchMetrics | None = None
) -> None:
    """Takes everything that has arrived, appends it once, then stops."""
    streams = stream.sparkSession.streams
    if watch is not None:
        streams.addListener(watch)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    try:
        _drain(query, timeout)
    finally:
        if watch is not None:
            watch.wait(query)
            streams.removeListener(watch)


def append_available_to_table(stream: DataFrame, table: str, checkpoint: str, timeout: float | None = None) -> None:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    _drain(query, timeout)


def _drain(query, timeout: float | None) -> None:
    """Waits until everything is taken, however long that is, unless a limit is given."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not drain within {timeout} s")


def ingest_bronze(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, schema: T.StructType = BRONZE,
    files_per_trigger: int | None = None, schema_location: str | None = None, timeout: float | None = None,
    watch: BatchMetrics | None = None,
) -> None:
    """Landing JSON -> bronze path. Each file once; new columns widen the path.

    Bronze holds the values as text. With a ``schema_location`` the columns and
    their types are inferred, kept there, and widened by newly landed files; a
    file that lands while this runs should wait for the next call, as its new
    columns would not be known yet. ``watch`` gets the lines read and those that did not parse, per batch.
    """
    if schema_location:
        schema = landing_schema(spark, landing, schema_location)
    stream = read_landing(spark, landing, schema, files_per_trigger)
    if watch is not None:
        stream = stream.observe("bronze", F.count(F.lit(1)).alias("rows_read"), F.count(CORRUPT).alias("rows_corrupt"))
    append_available(stream, bronze, checkpoint, timeout, watch)


def refine_silver(
    spark: SparkSession, bronze: str, silver: str, checkpoint: str, schema: T.StructType = BRONZE,
    threshold: float = MIN_CONFIDENCE, schema_location: str | None = None, timeout: float | None = None,
    watch: BatchMetrics | None = None,
) -> None:
    """Bronze path -> confident, clean relations. Unparsed lines stay in bronze. ``watch`` gets the rows kept per batch.

    The columns of the contract get their types; others stay text, so that the
    silver files of all schema versions agree (``read_typed`` gives them theirs).
    """
    if schema_location:
        schema = landing_schema(spark, bronze, schema_location, evolve=False)
    stream = spark.readStream.schema(with_corrupt_column(as_landed(schema))).parquet(bronze)
    kept = _parsed(stream, threshold)
    if watch is not None:
        kept = kept.observe("silver", F.count(F.lit(1)).alias("rows_kept"))
    append_available(kept, silver, checkpoint, timeout, watch)


def _parsed(stream: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    if CORRUPT in stream.columns:
        stream = stream.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return to_silver(stream, threshold)


def read_typed(spark: SparkSession, path: str, schema_location: str) -> DataFrame:
    """A bronze or silver path, its text columns with the types the kept schema has by now."""
    schema = landing_schema(spark, path, schema_location, evolve=False)
    rows = read_path(spark, path, merge_schema=True)
    text = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)}
    return typed(rows, T.StructType([f for f in schema.fields if f.name in text]))


def refine_silver_table(
    spark: SparkSession, bronze_table: str, silver_table: str, checkpoint: str, timeout: float | None = None
) -> None:
    """The same between two tables of the catalog. Columns that bronze gained are added to silver first."""
    refined_stream = _parsed(spark.readStream.table(bronze_table))
    if spark.catalog.tableExists(silver_table):
        have = set(spark.table(silver_table).columns)
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in refined_stream.schema.fields if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {silver_table} ADD COLUMNS ({', '.join(new)})")
    append_available_to_table(refined_stream, silver_table, checkpoint, timeout)


def scored_batch(relations: DataFrame, companies: DataFrame, bias: float) -> DataFrame:
    """Adds the prediction and the refined confidence; an unknown company changes nothing."""
    scored = score_relations(relations, companies, bias)
    return scored.withColumn("refined_probability", refined(F.col("gnn_prediction"), F.col("probability")))


def score_arrivals(
    spark: SparkSession, silver: str, companies: DataFrame, bias: float, out: str, checkpoint: str,
    schema: T.StructType = BRONZE, timeout: float | None = None,
) -> None:
    """Scores newly arrived relations against the written company table.

    Each micro-batch gets the checked or salted lookup of the batch path and
    replaces its own ``batch_id`` folder, so a replayed batch adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored_batch(batch, companies, bias).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        spark.readStream.schema(schema)
        .parquet(silver)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _drain(query, timeout)
