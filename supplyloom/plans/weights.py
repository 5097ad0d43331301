"""Weights of a link model: initial values, flat form and the versioned table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.operators.sage import LayerWeights, LinkModel
from supplyloom.params import Params

LAYER_PARTS = ("w_self", "w_neigh", "bias", "w_pool", "b_pool")
WEIGHTS_SCHEMA = "version long, aggregator string, name string, shape array<int>, values array<double>"


def initial_weights(params: Params) -> dict[str, np.ndarray]:
    """Seeded uniform start, scaled by fan-in and fan-out; biases at zero."""
    rng = np.random.default_rng(params.seed)
    width, hidden = params.num_node_features, params.hidden_dim

    def matrix(rows: int, cols: int) -> np.ndarray:
        limit = np.sqrt(6.0 / (rows + cols))
        return rng.uniform(-limit, limit, size=(rows, cols))

    out: dict[str, np.ndarray] = {}
    for layer, (n_in, n_out) in (("layer1", (width, hidden)), ("layer2", (hidden, width))):
        out[f"{layer}.w_self"] = matrix(n_out, n_in)
        out[f"{layer}.w_neigh"] = matrix(n_out, n_in)
        out[f"{layer}.bias"] = np.zeros(n_out)
        if params.aggregator_type == "pool":
            out[f"{layer}.w_pool"] = matrix(n_in, n_in)
            out[f"{layer}.b_pool"] = np.zeros(n_in)
    out["score.w"] = matrix(1, 2 * width)[0]
    out["score.b"] = np.zeros(1)
    return out


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in weights])


def unflatten(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, value in like.items():
        out[name] = flat[at : at + value.size].reshape(value.shape)
        at += value.size
    return out


def as_model(weights: dict[str, np.ndarray], aggregator: str) -> LinkModel:
    layers = [
        LayerWeights(**{p: weights[f"{n}.{p}"] for p in LAYER_PARTS if f"{n}.{p}" in weights})
        for n in ("layer1", "layer2")
    ]
    return LinkModel(*layers, weights["score.w"], float(weights["score.b"][0]), aggregator)


def save_weights(spark: SparkSession, weights: dict[str, np.ndarray], aggregator: str, path: str, version: int) -> None:
    """Appends one version; a few rows, whatever the size of the graph."""
    rows = [
        (version, aggregator, n, list(w.shape), [float(v) for v in w.ravel()]) for n, w in weights.items()
    ]
    spark.createDataFrame(rows, WEIGHTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def latest_version(stored: DataFrame) -> DataFrame:
    return stored.agg(F.max("version").alias("version"))


def load_weights(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict[str, np.ndarray], str]:
    """The given version, or the latest."""
    stored = spark.read.schema(WEIGHTS_SCHEMA).parquet(path)
    version = latest_version(stored).first().version if version is None else version
    rows = stored.filter(F.col("version") == version).collect()
    if not rows:
        raise ValueError(f"no weights of version {version} below {path}")
    weights = {r.name: np.array(r["values"]).reshape(r["shape"]) for r in rows}
    return weights, rows[0].aggregator
