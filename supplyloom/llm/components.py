"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from supplyloom.operators.joins import fits_broadcast, lookup
from supplyloom.storage import materialise, packed, rows_of


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) -> links (u, v), u < v, with the same components: in each batch every node to its smallest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            pairs = [(root(x), x) for x in parent]
            pairs = [(u, v) for u, v in pairs if u != v]
            columns = [pa.array(c, pa.int64()) for c in zip(*pairs)] or [pa.array([], pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    return links.mapInArrow(run, "u long, v long")


def _written(edges: DataFrame, most: int) -> tuple[DataFrame, tuple]:
    """The edges, ``most`` at most, written out, with their number and a sum that tells whether a round changed anything."""
    seen = Observation()
    mark = F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0x7FFFFFFF)))
    table = materialise(packed(edges, most).observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), "cc-links")
    return table, (seen.get["n"], seen.get["mark"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link, the component being its smallest node.

    Large-star and small-star rounds: the greater neighbours of a node, then its lesser ones and itself, are linked
    to the smallest around it, until nothing changes; a few rounds even for long chains, since paths halve. Each round
    is written out, so a lost executor costs one round. Minima are pre-aggregated, and the smallest nodes, which a giant
    component shares, are looked up by broadcast or with salted keys.
    """
    # Written first: links that come from Python workers would otherwise keep two workers busy in each task.
    given = materialise(links.select(a, b).where(F.col(a) != F.col(b)), "cc-given")
    edges, mark = _written(contracted(given).distinct(), rows_of(given))
    while mark[0]:
        parents, many = edges.groupBy(F.col("v").alias("u")).agg(F.min("u").alias("m")), mark[0]
        if not fits_broadcast(many, 16):
            parents = materialise(parents, "cc-parents")
            many = rows_of(parents)
        # large star: greater neighbours of u go to the smallest node around u
        large = lookup(edges, parents, "u", 16, F.col("v"), "left", rows=many)
        large = large.select(F.coalesce("m", "u").alias("u"), "v")
        # small star: the lesser neighbours of v, and v, go to the smallest of them
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v"))
        edges, after = _written(small.where("u <> v").distinct(), 2 * mark[0])
        if after == mark:
            break
        mark = after
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
