"""Node features: one table, keyed by company id, shared by all splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.draws import draw, standard_normals


def normal_features(nodes: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """Seeded standard-normal vector per node: the same company always gets the same one.

    Values are of single precision, which is how training examples carry them.
    """
    normals = standard_normals(count, "feature", seed, F.col("id"))
    return nodes.select("id", normals.cast("array<float>").cast("array<double>").alias("x"))


def integer_features(nodes: DataFrame, count: int) -> DataFrame:
    """Whole numbers in [-1000, 1000]; sums of them are exact in doubles."""
    values = [(draw("f", F.col("id"), k) % 2001 - 1000).cast("double") for k in range(count)]
    return nodes.select("id", F.array(*values).alias("x"))


def given_features(nodes: DataFrame, vectors: DataFrame, id_column: str, vector_column: str, width: int) -> DataFrame:
    """Real vectors where there are any, zeros elsewhere."""
    table = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("x")
    )
    return nodes.join(table, "id", "left").select(
        "id", F.coalesce("x", F.array_repeat(F.lit(0.0), width)).alias("x")
    )
