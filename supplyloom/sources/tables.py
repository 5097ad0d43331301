"""Namespaces, batch tables and CSV dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DIMENSION_TABLES = ("company_risk_data", "company_locations", "company_risk_frame")


def use_database(
    spark: SparkSession, database: str, create: bool = True, location: str | None = None
) -> None:
    if create:
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    spark.sql(f"USE `{database}`")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header row, comma separated; types inferred unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", ",")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def load_dimension_tables(
    spark: SparkSession,
    folder: str,
    names=DIMENSION_TABLES,
    schemas: dict[str, T.StructType] | None = None,
) -> None:
    """``<folder>/<name>.csv`` becomes table ``<name>``, replaced as a whole."""
    for name in names:
        frame = read_csv(spark, f"{folder}/{name}.csv", (schemas or {}).get(name))
        overwrite_table(frame, name)


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def overwrite_path(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_path(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def preview(df: DataFrame, rows: int = 1000) -> DataFrame:
    return df.limit(rows)
