"""Landing folders of JSON lines and the schema kept next to them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from supplyloom.sources.schemas import BRONZE, as_landed, with_corrupt_column


MAX_FILE_AGE = "36500d"


def _stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The newest stored schema."""
    try:
        versions = spark.read.schema("version long, schema_json string").json(f"{location}/versions")
        newest = versions.orderBy(F.desc("version")).first()
    except AnalysisException:
        return None
    return None if newest is None else T.StructType.fromJson(json.loads(newest.schema_json))


def _new_files(spark: SparkSession, folder: str, location: str) -> list[str]:
    """Files of the folder that were not looked at before, whatever their times say."""
    try:
        there = spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException:
        return []
    try:
        seen = spark.read.schema("path string").parquet(f"{location}/files")
        there = there.join(seen, "path", "left_anti")
    except AnalysisException:
        pass
    # The file listing of one call, which the driver holds for any file source.
    return [r.path for r in there.collect()]


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text holds everything."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    numbers = (T.LongType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    return T.StringType()


def merge_schemas(known: T.StructType, found: T.StructType) -> T.StructType:
    """Known columns keep their place and widen their type; new ones are added at the end."""
    new = {f.name: f for f in found.fields}
    kept = [T.StructField(f.name, widen(f.dataType, new[f.name].dataType) if f.name in new else f.dataType) for f in known.fields]
    names = set(known.fieldNames())
    return T.StructType([*kept, *[f for f in found.fields if f.name not in names]])


def landing_schema(
    spark: SparkSession, folder: str, schema_location: str, evolve: bool = True
) -> T.StructType:
    """Infers the column types of a landing folder and keeps them, in versions.

    A later call looks at the files it has not seen, adds their new columns and widens types.
    """
    stored = _stored_schema(spark, schema_location)
    if stored and not evolve:
        return stored
    files = _new_files(spark, folder, schema_location)
    found = spark.read.option("mode", "PERMISSIVE").json(files).schema if files else T.StructType()
    found = T.StructType([f for f in found.fields if f.name != "_corrupt_record"])
    schema = merge_schemas(stored, found) if stored else found
    if not schema.fields:
        raise ValueError(f"no column could be inferred from {folder}")
    if not stored or schema != stored:
        version = spark.sql("select unix_micros(current_timestamp()) as v").first().v
        row = spark.createDataFrame([(version, schema.json())], "version long, schema_json string")
        row.coalesce(1).write.mode("append").json(f"{schema_location}/versions")
    if files:
        spark.createDataFrame([(f,) for f in files], "path string").write.mode("append").parquet(f"{schema_location}/files")
    return schema


def read_landing(
    spark: SparkSession, folder: str, schema: T.StructType = BRONZE, files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming JSON source, columns as text. A line that does not parse lands in the corrupt column.

    Files count however old their times are: one may be written long before it is moved into the folder.
    """
    reader = spark.readStream.schema(with_corrupt_column(as_landed(schema))).option("mode", "PERMISSIVE")
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)
