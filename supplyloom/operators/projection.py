"""A two-dimensional view of a sample of the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.vectors import dot, literal
from supplyloom.operators.graph import exact_sample
from supplyloom.storage import materialise


def embedding_projection(embeddings: DataFrame, fraction: float = 0.1, seed: int = 0) -> DataFrame:
    """``(id, x, y)``: first two principal components of an exact-size sample."""
    sample = materialise(exact_sample(embeddings.select("id", "x"), fraction, "id", seed), "sample")
    vectors = sample.select("id", array_to_vector("x").alias("v"))
    fitted = PCA(k=2, inputCol="v", outputCol="p").fit(vectors)
    flat = vector_to_array("p")
    return fitted.transform(vectors).select("id", flat[0].alias("x"), flat[1].alias("y"))


def leading_axes(covariance: np.ndarray, count: int = 2, steps: int = 60) -> list[np.ndarray]:
    """Leading unit eigenvectors by a fixed number of power iterations each, their greatest component positive."""
    matrix, axes = covariance.astype(float), []
    for _ in range(count):
        axis = np.full(len(matrix), 1 / np.sqrt(len(matrix)))
        for _ in range(steps):
            moved = matrix @ axis
            length = np.sqrt(moved @ moved)
            axis = moved / length if length else axis
        matrix = matrix - (axis @ matrix @ axis) * np.outer(axis, axis)
        axes.append(axis * np.sign(axis[np.abs(axis).argmax()] or 1))
    return axes


def power_projection(embeddings: DataFrame, width: int, fraction: float = 0.1, seed: int = 0, steps: int = 60) -> DataFrame:
    """``(id, x, y)`` of an exact-size sample on the two leading axes of its covariance.

    One aggregate gives the covariance, of as many numbers as the width squared; the axes are found from that alone.
    """
    sample = materialise(exact_sample(embeddings.select("id", "x"), fraction, "id", seed), "sample")
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    found = sample.agg(*[F.covar_samp(F.col("x")[i], F.col("x")[j]) for i, j in pairs]).first()
    covariance = np.zeros((width, width))
    for (i, j), value in zip(pairs, found):
        covariance[i, j] = covariance[j, i] = 0.0 if value is None else value
    axes = leading_axes(covariance, 2, steps)
    return sample.select("id", *[dot(F.col("x"), literal(a)).alias(n) for n, a in zip("xy", axes)])
