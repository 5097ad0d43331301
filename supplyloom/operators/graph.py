"""The directed multigraph held as an edge table ``(eid, src_id, dst_id)``.

An edge points from purchaser to seller. Parallel edges and self-loops are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.functions.draws import DRAW_BITS, draw
from supplyloom.operators.position import values_at, with_position
from supplyloom.storage import rows_of, with_known_rows

SPLITS = ("training", "validation", "testing")


def edges_of(relations: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """Edge table of a relation table; a relation without both ids is no edge.

    Uses the table's own ``eid``; without one, edges are numbered in ``order_by``
    order, which must be total for the numbers to be repeatable.
    """
    relations = relations.filter(F.col("src_id").isNotNull() & F.col("dst_id").isNotNull())
    if "eid" in relations.columns:
        return relations.select("eid", "src_id", "dst_id")
    if order_by is None:
        raise ValueError("relations without eid need an order_by that numbers them")
    return with_position(relations, order_by, name="eid").select("eid", "src_id", "dst_id")


def node_set(edges: DataFrame) -> DataFrame:
    """Companies that occur at either end. One scan, pre-aggregated before the shuffle."""
    return edges.select(F.explode(F.array("src_id", "dst_id")).alias("id")).distinct()


def dense_nodes(edges: DataFrame) -> DataFrame:
    """All ids 0..max, gaps included."""
    top = edges.agg(F.max(F.greatest("src_id", "dst_id")).alias("top")).first().top
    return edges.sparkSession.range(0, 0 if top is None else top + 1)


def graph_counts(edges: DataFrame) -> DataFrame:
    per_edge = edges.agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.lit(None).cast("bigint").alias("n_nodes"),
        (F.max(F.greatest("src_id", "dst_id")) + 1).alias("n_dense_nodes"),
    )
    per_node = node_set(edges).agg(
        F.lit(None).cast("bigint").alias("n_edges"),
        F.count(F.lit(1)).alias("n_nodes"),
        F.lit(None).cast("bigint").alias("n_dense_nodes"),
    )
    names = per_edge.columns
    return per_edge.unionByName(per_node).agg(*[F.max(c).alias(c) for c in names])


def degrees(edges: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.col("src_id").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst_id").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )
    return (
        edges.select(F.explode(ends).alias("e"))
        .groupBy(F.col("e.id").alias("id"))
        .agg(F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))
    )


def degree_distribution(edges: DataFrame) -> DataFrame:
    """How many companies have each degree, per direction."""
    kinds = F.array(
        F.struct(F.lit("in").alias("direction"), F.col("in_degree").alias("degree")),
        F.struct(F.lit("out").alias("direction"), F.col("out_degree").alias("degree")),
    )
    return (
        degrees(edges)
        .select(F.explode(kinds).alias("d"))
        .groupBy("d.direction", "d.degree")
        .agg(F.count(F.lit(1)).alias("n_nodes"))
    )


def hubs(edges: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Companies that take part in at least ``min_share`` of all edges."""
    n = edges.count()
    return degrees(edges).filter(
        F.greatest("out_degree", "in_degree") >= F.lit(min_share * n)
    )


def edge_split(edges: DataFrame, test_p: float = 0.10, valid_p: float = 0.20) -> DataFrame:
    """Adds ``split``: in the order of ``eid`` the first edges train, the next validate, the last test.

    The two ids at which the split changes are found by counting; the edges themselves stay where they are.
    """
    n = rows_of(edges)
    # int(p * n) in doubles, as a split by fractions is usually written
    test, valid = math.floor(test_p * n), math.floor(valid_p * n)
    train = n - valid - test
    starts = values_at(edges, "eid", [train, train + valid])
    split = F.lit(SPLITS[0])
    if train in starts:
        split = F.when(F.col("eid") < F.lit(starts[train][0]), split).otherwise(SPLITS[1])
    if train + valid in starts:
        split = F.when(F.col("eid") < F.lit(starts[train + valid][0]), split).otherwise(SPLITS[2])
    return with_known_rows(edges.withColumn("split", split), n)


#: Rows of a bucket of the random order, about, and buckets at most.
BUCKET_ROWS, BUCKET_BITS = 4096, 16


def shuffled_batches(edges: DataFrame, batch_size: int, seed: int = 0, by: list[str] = ("split",)) -> DataFrame:
    """Adds ``batch_id`` per split: seeded random order, last partial batch kept.

    With ``by=[]`` the edges are one split. The keys are uniform, so their leading bits are buckets of equal size: a
    count per bucket gives its first position, and a window in each bucket the rest. One shuffle, nothing written.
    """
    by, n = list(by), rows_of(edges)
    bits = min(BUCKET_BITS, max(0, math.ceil(math.log2(max(1, n) / BUCKET_ROWS))))
    keyed = edges.withColumn("__key", draw("batch", seed, F.col("eid"))).withColumn(
        "__bucket", F.shiftright("__key", DRAW_BITS - bits).cast("int")
    )
    # At most 2**BUCKET_BITS rows for each split.
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    here = Window.partitionBy(*by, "__bucket").orderBy("__key", "eid")
    placed = keyed.withColumn("__place", F.row_number().over(here) - 1).join(offsets, [*by, "__bucket"])
    batch = F.floor((F.col("__first") + F.col("__place")) / F.lit(batch_size)).cast("bigint")
    return with_known_rows(placed.select(*edges.columns, batch.alias("batch_id")), n)


def first_batches(batched: DataFrame, max_steps: int) -> DataFrame:
    """The step cap: one pass, at most ``max_steps`` batches."""
    return batched.filter(F.col("batch_id") < F.lit(max_steps))


def exact_sample(df: DataFrame, fraction: float, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``round(n * fraction)`` rows without replacement, halves rounded to even.

    Rows are taken by their place in hash order up to a hash found by counting; only rows of that very hash, if the
    sample ends among them, are sorted.
    """
    n = rows_of(df)
    size = round(n * float(fraction))
    keyed = df.withColumn("__key", draw("sample", seed, F.col(key)))
    last = values_at(keyed, "__key", [size - 1]).get(size - 1)
    if last is None:
        return df.limit(0)
    value, below = last
    ties = keyed.filter(F.col("__key") == F.lit(value)).orderBy(key).limit(size - below)
    return keyed.filter(F.col("__key") < F.lit(value)).union(ties).drop("__key")
