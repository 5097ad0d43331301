"""Relational core: bronze -> silver -> scored -> refined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.names import basename
from supplyloom.sources.schemas import BRONZE, typed

MIN_CONFIDENCE = 0.55
REVIEW_PREDICTION = 0.8
REVIEW_CONFIDENCE = 0.6


def confidence_filter(relations: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    return relations.filter(F.col("probability") >= F.lit(threshold))


def clean_names(relations: DataFrame) -> DataFrame:
    return relations.withColumn("Purchaser", basename(F.col("Purchaser"))).withColumn(
        "Seller", basename(F.col("Seller"))
    )


def to_silver(relations: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    """Works on batch and streaming frames alike, and on landed text as on typed columns."""
    return clean_names(confidence_filter(typed(relations, BRONZE), threshold))


def cast_probability(relations: DataFrame, column: str = "probability") -> DataFrame:
    """To double; text that is no number becomes null."""
    return relations.withColumn(column, F.col(column).try_cast("double"))


def edge_columns(relations: DataFrame, *keep: str) -> DataFrame:
    return relations.select(*keep, "src_id", "dst_id")


def with_label(edges: DataFrame, label: int) -> DataFrame:
    return edges.withColumn("label", F.lit(label))


def review_links(
    scored: DataFrame,
    min_prediction: float = REVIEW_PREDICTION,
    max_confidence: float = REVIEW_CONFIDENCE,
) -> DataFrame:
    """Links the model likes much more than the source does."""
    return scored.filter(
        (F.col("gnn_prediction") > F.col("probability"))
        & (F.col("gnn_prediction") > F.lit(min_prediction))
        & (F.col("probability") < F.lit(max_confidence))
    ).select("Purchaser", "Seller", "probability", "gnn_prediction")


def refined(prediction: Column, probability: Column) -> Column:
    """The higher of both; a missing prediction keeps the probability and a
    missing probability stays missing."""
    return F.when(prediction >= probability, prediction).otherwise(probability)


def refine_confidence(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "probability", refined(F.col("gnn_prediction"), F.col("probability"))
    ).drop("gnn_prediction")
