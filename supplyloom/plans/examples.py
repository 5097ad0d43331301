"""Training examples that carry their own sampled neighbourhoods.

A gradient step must not shuffle, so every example row holds the blocks of its
purchaser, its seller and its negatives. Only the batches a run will use are
built; the table is laid out by batch, each batch in several files.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.joins import lookup
from supplyloom.operators.sampling import exact_negatives, fanout_of, node_index, uniform_negatives
from supplyloom.operators.graph import node_set
from supplyloom.params import Params
from supplyloom.storage import materialise, rows_of, stored, with_known_rows

PART_BYTES = 8 << 20
NO_EDGE = -1


@dataclass(frozen=True)
class Shape:
    """Layout of a node's block, a fixed-size record: its own vector, those of its
    sampled in-neighbours, those of their in-neighbours, then the edge ids that
    brought them (NO_EDGE and zeros where there is none)."""

    width: int
    fanout: int
    others: int  # seller and negatives per example, at most

    @property
    def vector_sizes(self) -> tuple[int, int, int, int]:
        f, d = self.fanout, self.width
        return d, f * d, f * d, f * f * d

    @property
    def edge_sizes(self) -> tuple[int, int, int]:
        return self.fanout, self.fanout, self.fanout**2

    @property
    def block_bytes(self) -> int:
        """Vectors are in single precision, edge ids are longs."""
        return 4 * sum(self.vector_sizes) + 8 * sum(self.edge_sizes)

    @property
    def row_bytes(self) -> int:
        return self.block_bytes * (1 + self.others)


def _packed(shape: Shape) -> Column:
    """One binary per node: joins, shuffles and scans then copy bytes, not elements."""

    @F.arrow_udf("binary")
    def pack(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        parts = []
        for column, kind in zip(columns, [np.float32] * 4 + [np.int64] * 3):
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            parts.append(np.ascontiguousarray(flat).view(np.uint8).reshape(n, -1) if n else flat.view(np.uint8))
        data = np.hstack(parts) if n else np.empty(0, np.uint8)
        offsets = np.arange(n + 1, dtype=np.int32) * shape.block_bytes
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])

    return pack("x", "x1", "x2", "x21", "e1", "e2", "e21")


def _padded(values: Column, size: int, pad: Column) -> Column:
    return F.slice(F.concat(values, F.array_repeat(pad, size)), 1, size)


def _gathered(sample: DataFrame, table: DataFrame, columns: dict[str, tuple[str, int, Column]], row_bytes: int) -> DataFrame:
    """Collects the sampled neighbours of each node (at most ``fanout``) into padded arrays."""
    keyed = table.withColumnRenamed("id", "nbr_id")
    joined = lookup(sample, keyed, "nbr_id", row_bytes, F.col("node_id"), rows=rows_of(table), store=True)
    item = F.struct("slot", "eid", *[c for c in keyed.columns if c != "nbr_id"])
    slots = joined.groupBy(F.col("node_id").alias("id")).agg(F.array_sort(F.collect_list(item)).alias("s"))
    out = []
    for name, (source, size, pad) in columns.items():
        values = F.col(f"s.{source}")
        values = values if source == "eid" else F.flatten(values)
        out.append(_padded(values, size, pad).alias(name))
    return slots.select("id", *out)


def node_blocks(
    seeds: DataFrame, message_edges: DataFrame, features: DataFrame, params: Params, shape: Shape
) -> DataFrame:
    """``(id, block)`` of the seed nodes.

    Only the nodes that matter are sampled, where their list is short enough to be sent out.
    """
    width, fan = params.num_node_features, params.fanout
    none, nil = F.lit(NO_EDGE).cast("bigint"), F.lit(0.0).cast("float")
    seeds = materialise(seeds.select("id"), "seeds")
    outer = materialise(fanout_of(seeds, message_edges, 2, params.seed, fan), "outer")
    frontier = materialise(
        seeds.union(outer.select(F.col("nbr_id").alias("id"))).distinct(), "frontier"
    )
    inner = fanout_of(frontier, message_edges, 1, params.seed, fan)

    features = stored(features, "features")
    rows = rows_of(features)
    features = with_known_rows(features.select("id", F.col("x").cast("array<float>").alias("x")), rows)
    near = _gathered(
        inner, features, {"e1": ("eid", fan, none), "x1": ("x", fan * width, nil)}, 4 * width + 32
    )
    block1 = materialise(
        features.join(frontier, "id", "left_semi")
        .join(near, "id", "left")
        .select(
            "id", "x",
            F.coalesce("e1", F.array_repeat(none, fan)).alias("e1"),
            F.coalesce("x1", F.array_repeat(nil, fan * width)).alias("x1"),
        ),
        "block1",
    )
    far = _gathered(
        outer, block1,
        {
            "e2": ("eid", fan, none),
            "x2": ("x", fan * width, nil),
            "e21": ("e1", fan * fan, none),
            "x21": ("x1", fan * fan * width, nil),
        },
        4 * width * (1 + fan) + 8 * fan + 64,
    )
    return (
        block1.join(seeds, "id", "left_semi")
        .join(far, "id", "left")
        .select(
            "id", "x", "e1", "x1",
            F.coalesce("e2", F.array_repeat(none, fan)).alias("e2"),
            F.coalesce("x2", F.array_repeat(nil, fan * width)).alias("x2"),
            F.coalesce("e21", F.array_repeat(none, fan * fan)).alias("e21"),
            F.coalesce("x21", F.array_repeat(nil, fan * fan * width)).alias("x21"),
        )
        .select("id", _packed(shape).alias("block"))
    )


def draw_negatives(positives: DataFrame, known: DataFrame, params: Params, index: DataFrame | None = None) -> DataFrame:
    """Negatives of ``positives`` among the companies of ``known``, or of a given node index."""
    index = node_index(node_set(known)) if index is None else index
    if params.strict_negatives:
        return exact_negatives(positives, params.num_negative_samples, known, index=index, seed=params.seed)
    return uniform_negatives(positives, params.num_negative_samples, index=index, seed=params.seed)


def training_examples(
    batched: DataFrame, message_edges: DataFrame, features: DataFrame, params: Params
) -> tuple[DataFrame, Shape]:
    """One row per positive edge of the capped batches, stored by ``batch_id``.

    ``batched`` has ``eid, src_id, dst_id, batch_id``. Columns of the result:
    ``batch_id, part, eid``, the purchaser's block as ``buyer`` and, as ``others``,
    the blocks of the seller and of the negatives in draw order.
    """
    shape = Shape(params.num_node_features, params.fanout, 1 + params.num_negative_samples)
    positives = materialise(batched.select("eid", "src_id", "dst_id", "batch_id"), "positives")
    if not positives.groupBy("eid").count().filter(F.col("count") > 1).isEmpty():
        raise ValueError("eid must be unique: it ties negatives and sampled neighbours to their edge")
    negatives = draw_negatives(positives.drop("batch_id"), message_edges, params)
    others = materialise(
        positives.select("eid", F.col("dst_id").alias("id"), F.lit(0).alias("draw"))
        .unionByName(negatives.select("eid", F.col("dst_id").alias("id"), "draw")),
        "others",
    )
    seeds = positives.select(F.col("src_id").alias("id")).union(others.select("id")).distinct()
    blocks = materialise(node_blocks(seeds, message_edges, features, params, shape), "blocks")

    placed = lookup(others, blocks, "id", shape.block_bytes, F.col("eid"))
    # At most 1 + k blocks per edge.
    slots = F.array_sort(F.collect_list(F.struct("draw", "block"))).getField("block")
    grouped = placed.groupBy("eid").agg(slots.alias("others"))
    buyers = blocks.select(F.col("id").alias("src_id"), F.col("block").alias("buyer"))
    rows = lookup(positives, buyers, "src_id", shape.block_bytes, F.col("eid"), rows=rows_of(blocks))
    rows = rows.join(grouped, "eid").select("batch_id", "eid", "buyer", "others")
    parts = max(1, -(-params.batch_size * shape.row_bytes // PART_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("eid"), F.lit(parts)).cast("int"))
    laid_out = rows.repartition("batch_id", "part")
    return materialise(laid_out, "examples", partition_by="batch_id"), shape
