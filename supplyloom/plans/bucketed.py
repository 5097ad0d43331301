"""A graph laid out once by company, from which every batch draws fresh neighbourhoods without a shuffle.

The message edges are a table bucketed and sorted by the company that receives them. A batch's companies are few and go
to every task, the window that draws a company's neighbours finds its rows in its bucket, and nothing is exchanged but
the broadcast ids. Draws are keyed by the batch, so each batch and pass sees other neighbours and a retry the same ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyloom.functions.draws import draw
from supplyloom.operators.joins import fits_broadcast
from supplyloom.storage import materialise, rows_of, scratch_path

#: Rows of a bucket, about.
BUCKET_ROWS = 4_000_000


@dataclass(frozen=True)
class BucketedGraph:
    spark: SparkSession
    name: str  # of the table of message edges: node_id, nbr_id, eid

    @property
    def messages(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def bucketed_graph(edges: DataFrame, buckets: int | None = None) -> BucketedGraph:
    """Writes the message edges (eid, src_id, dst_id) into buckets by receiver, as an external table of the session's database."""
    spark, name = edges.sparkSession, f"messages_{uuid.uuid4().hex[:12]}"
    n = buckets or max(8, -(-rows_of(edges) // BUCKET_ROWS))
    rows = edges.select(F.col("dst_id").alias("node_id"), F.col("src_id").alias("nbr_id"), "eid")
    # By bucket first, so that each is one file.
    laid_out = rows.repartition(n, "node_id")
    writer = laid_out.write.format("parquet").bucketBy(n, "node_id").sortBy("node_id").option("path", scratch_path(spark, "bucketed"))
    writer.saveAsTable(name)
    return BucketedGraph(spark, name)


def _drawn(graph: BucketedGraph, ids: DataFrame, layer: int, batch: int, seed: int, fanout: int) -> DataFrame:
    near = F.broadcast(ids) if fits_broadcast(rows_of(ids), 16) else ids
    found = graph.messages.join(near.withColumnRenamed("id", "node_id"), "node_id", "left_semi")
    keyed = found.withColumn("key", draw("fresh", seed, layer, batch, F.col("eid")))
    slot = F.row_number().over(Window.partitionBy("node_id").orderBy("key", "eid"))
    return keyed.withColumn("slot", slot).filter(F.col("slot") <= fanout).select(F.lit(layer).alias("layer"), "node_id", "nbr_id", "eid", "slot")


def fresh_blocks(graph: BucketedGraph, seeds: DataFrame, batch: int, seed: int = 0, fanout: int = 4) -> DataFrame:
    """``layer, node_id, nbr_id, eid, slot``: the sampled blocks of one batch's companies ``(id)``, drawn for this batch.

    Layer 2 holds the in-edges of the companies, layer 1 those of the companies and of what layer 2 reaches.
    """
    seeds = materialise(seeds.select("id"), "seeds")
    outer = materialise(_drawn(graph, seeds, 2, batch, seed, fanout), "outer")
    # An id may stand there several times: a semi join asks only whether it does.
    frontier = materialise(seeds.union(outer.select("nbr_id")), "frontier")
    return outer.unionByName(_drawn(graph, frontier, 1, batch, seed, fanout))
