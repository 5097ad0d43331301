"""Neighbourhood aggregation (GraphSAGE) as joins and aggregations.

One layer is ``W_self h_v + W_neigh AGG(h_u) + b`` over the in-neighbours u of v.
Parallel edges are folded into a multiplicity before anything is joined, hot
neighbours are salted, and the mean is a partial + final aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.vectors import affine, dot, literal, zeros
from supplyloom.operators.joins import Spreads, hot_keys, lookup
from supplyloom.storage import materialise, rows_of, stored


@dataclass(frozen=True)
class LayerWeights:
    w_self: np.ndarray
    w_neigh: np.ndarray
    bias: np.ndarray
    w_pool: np.ndarray | None = None
    b_pool: np.ndarray | None = None

    @property
    def width_in(self) -> int:
        return self.w_self.shape[1]

    @property
    def width_out(self) -> int:
        return self.w_self.shape[0]


@dataclass(frozen=True)
class LinkModel:
    """Two layers and the linear score of a pair of embeddings."""

    layer1: LayerWeights
    layer2: LayerWeights
    score_w: np.ndarray
    score_b: float
    aggregator: str = "mean"


@dataclass
class MessageGraph:
    """Message edges with parallel ones folded, and the purchasers that are hot."""

    pairs: DataFrame  # nbr_id, node_id, multiplicity
    floor: int | None = None

    @classmethod
    def of(cls, neighbours: DataFrame, floor: int | None = None) -> "MessageGraph":
        """``neighbours`` has ``node_id`` and ``nbr_id``, in full or sampled."""
        folded = neighbours.groupBy("nbr_id", "node_id").agg(F.count(F.lit(1)).alias("multiplicity"))
        return cls(materialise(folded, "pairs"), floor)

    @cached_property
    def hot(self) -> Spreads:
        return hot_keys(self.pairs, "nbr_id", floor=self.floor)["nbr_id"]


def _messages(graph: MessageGraph, vectors: DataFrame, width: int) -> DataFrame:
    table = vectors.select(F.col("id").alias("nbr_id"), F.col("x").alias("m"))
    salt = F.col("node_id")
    return lookup(
        graph.pairs, table, "nbr_id", 8 * width + 32, salt, hot=lambda: graph.hot, rows=rows_of(vectors)
    )


def neighbour_mean(graph: MessageGraph, vectors: DataFrame, width: int) -> DataFrame:
    """``(node_id, mean)`` over in-neighbours, parallel edges counted each time."""
    sums = [F.expr(f"sum(m[{i}] * multiplicity)").alias(f"s{i}") for i in range(width)]
    total = _messages(graph, vectors, width).groupBy("node_id").agg(*sums, F.sum("multiplicity").alias("n"))
    means = ", ".join(f"s{i} / n" for i in range(width))
    return total.select("node_id", F.expr(f"array({means})").alias("agg"))


def neighbour_max(graph: MessageGraph, vectors: DataFrame, width: int) -> DataFrame:
    tops = [F.expr(f"max(m[{i}])").alias(f"s{i}") for i in range(width)]
    top = _messages(graph, vectors, width).groupBy("node_id").agg(*tops)
    return top.select("node_id", F.array(*[f"s{i}" for i in range(width)]).alias("agg"))


def pool_inputs(vectors: DataFrame, weights: LayerWeights) -> DataFrame:
    """``relu(W_pool h + b_pool)``, once per node and not once per edge."""
    pooled = affine([("x", weights.w_pool)], weights.b_pool, rectify=True)
    return vectors.select("id", pooled.alias("x"))


def sage_layer(
    vectors: DataFrame, graph: MessageGraph, weights: LayerWeights, aggregator: str = "mean", rectify: bool = False
) -> DataFrame:
    """One layer over all nodes of ``vectors``, a written table ``(id, x)``."""
    width = weights.width_in
    if aggregator == "mean":
        gathered = neighbour_mean(graph, vectors, width)
    elif aggregator == "pool":
        pooled = materialise(pool_inputs(vectors, weights), "pooled")
        gathered = neighbour_max(graph, pooled, width)
    else:
        raise ValueError(f"unknown aggregator {aggregator!r}")
    none = zeros(width)
    joined = vectors.join(gathered.withColumnRenamed("node_id", "id"), "id", "left").select(
        "id", "x", F.coalesce("agg", none).alias("agg")
    )
    out = affine([("x", weights.w_self), ("agg", weights.w_neigh)], weights.bias, rectify)
    return joined.select("id", out.alias("x"))


def embed(
    features: DataFrame,
    model: LinkModel,
    graph1: MessageGraph,
    graph2: MessageGraph | None = None,
    final_relu: bool = False,
) -> DataFrame:
    """Embeddings ``(id, x)`` of all nodes, layer by layer.

    One graph for both layers is full-neighbour inference; two sampled graphs
    give the sampled encoder. The layers are written out in between, since each
    is read twice: as neighbour and as the node itself.
    """
    x = stored(features, "features")
    h1 = materialise(sage_layer(x, graph1, model.layer1, model.aggregator, True), "h1")
    return sage_layer(h1, graph2 or graph1, model.layer2, model.aggregator, final_relu)


def embed_new(
    new_ids: DataFrame, features: DataFrame, edges: DataFrame, model: LinkModel, final_relu: bool = False
) -> DataFrame:
    """Embeddings of companies the model never saw, from their two-hop neighbourhood only."""
    neighbours = edges.select(F.col("dst_id").alias("node_id"), F.col("src_id").alias("nbr_id"))

    @cache
    def hot() -> Spreads:
        return hot_keys(neighbours, "node_id")["node_id"]

    def into(ids: DataFrame) -> DataFrame:
        keys = ids.withColumnRenamed("id", "node_id")
        found = lookup(neighbours, keys, "node_id", 32, F.col("nbr_id"), "left_semi", hot, rows=rows_of(ids))
        return materialise(found, "reached")

    def and_sources(ids: DataFrame, found: DataFrame) -> DataFrame:
        return materialise(ids.union(found.select(F.col("nbr_id").alias("id"))).distinct(), "nodes")

    wanted = materialise(new_ids.select("id").distinct(), "nodes")
    outer = into(wanted)
    frontier = and_sources(wanted, outer)
    inner = into(frontier)
    touched = and_sources(frontier, inner)
    x = materialise(features.select("id", "x").join(touched, "id", "left_semi"), "features")
    h1 = sage_layer(x, MessageGraph.of(inner), model.layer1, model.aggregator, True)
    h1 = materialise(h1.join(frontier, "id", "left_semi"), "h1")
    h2 = sage_layer(h1, MessageGraph.of(outer), model.layer2, model.aggregator, final_relu)
    return h2.join(wanted, "id", "left_semi")


def endpoint_scores(embeddings: DataFrame, model: LinkModel) -> DataFrame:
    """``(id, as_buyer, as_seller)``: the linear score split into its two halves.

    ``w . [h_u ; h_v] + b`` is a sum of one number per end, so only two numbers
    per company ever travel to the edges instead of two vectors.
    """
    half = model.layer2.width_out
    w = np.asarray(model.score_w, dtype=float).ravel()
    return embeddings.select(
        "id", dot(F.col("x"), literal(w[:half])).alias("as_buyer"), dot(F.col("x"), literal(w[half:])).alias("as_seller")
    )
