"""Connected components of an undirected graph of any shape, as a few narrow joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.joins import lookup
from supplyloom.storage import materialise, rows_of


def _stored(edges: DataFrame, label: str) -> DataFrame:
    return materialise(edges.filter("v <> m").distinct(), label)


def _large_star(edges: DataFrame, floor: int | None) -> DataFrame:
    """Every larger neighbour of a node hangs on the smallest of the node and its neighbours."""
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(edges.select("m", "v"))
    lowest = materialise(both.groupBy("u").agg(F.least("u", F.min("w")).alias("low")), "lowest")
    joined = lookup(both.filter("w > u"), lowest, "u", 16, F.col("w"), rows=rows_of(lowest), floor=floor)
    return _stored(joined.select(F.col("w").alias("v"), F.col("low").alias("m")), "large-star")


def _small_star(edges: DataFrame, floor: int | None) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    lowest = materialise(edges.groupBy("v").agg(F.min("m").alias("low")), "lowest")
    joined = lookup(edges, lowest, "v", 16, F.col("m"), rows=rows_of(lowest), floor=floor)
    both = joined.select(F.col("m").alias("v"), F.col("low").alias("m")).union(lowest.select("v", F.col("low").alias("m")))
    return _stored(both, "small-star")


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(pairs: DataFrame, floor: int | None = None) -> DataFrame:
    """``(id, component)`` of every id in the pairs ``(a, b)``: the smallest id that it is linked with.

    Large and small stars in turn until nothing changes: a logarithmic number of rounds for long chains, and a node
    with many neighbours is a salted key. An id that is paired with itself alone is its own component.
    """
    pairs = materialise(pairs.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b"), "pairs")
    edges = _stored(pairs.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")), "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = _small_star(_large_star(edges, floor), floor)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # Stars now: each id but a centre has one row.
    found = ids.join(edges.withColumnRenamed("v", "id"), "id", "left")
    return found.select("id", F.coalesce("m", "id").alias("component"))
