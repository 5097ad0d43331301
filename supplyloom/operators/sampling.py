"""Neighbour fan-out and negative edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.functions.draws import draw, draw_below
from supplyloom.operators.joins import NOT_HOT, fits_broadcast, lookup
from supplyloom.operators.position import running_totals, with_position
from supplyloom.operators.refine import with_label
from supplyloom.storage import materialise, rows_of


def fanout_sample(
    edges: DataFrame, layer: int, seed: int = 0, fanout: int = 4, by: list[str] = ()
) -> DataFrame:
    """At most ``fanout`` in-edges per node, uniform, without replacement.

    Planned as a per-partition group limit ahead of the shuffle, so a hub sends
    at most ``fanout`` rows per input partition.
    """
    by = list(by)
    keyed = edges.select(
        *by,
        F.col("dst_id").alias("node_id"),
        F.col("src_id").alias("nbr_id"),
        "eid",
        draw("fanout", seed, layer, F.col("eid")).alias("__key"),
    )
    order = Window.partitionBy(*by, "node_id").orderBy("__key", "eid")
    return (
        keyed.withColumn("slot", F.row_number().over(order))
        .filter(F.col("slot") <= fanout)
        .drop("__key")
    )


def fanout_of(ids: DataFrame, edges: DataFrame, layer: int, seed: int = 0, fanout: int = 4) -> DataFrame:
    """The fan-out sample of the nodes in ``ids``, a written table.

    Few nodes are broadcast, and only their edges are ranked; for many, the sample cuts hubs before its shuffle, so
    it is taken first and restricted on the same partitioning. A node's sample is the same either way.
    """
    if fits_broadcast(rows_of(ids), 16):
        return fanout_sample(edges.join(F.broadcast(ids.select(F.col("id").alias("dst_id"))), "dst_id", "left_semi"), layer, seed, fanout)
    keys = ids.select(F.col("id").alias("node_id"))
    return fanout_sample(edges, layer, seed, fanout).join(keys, "node_id", "left_semi")


def full_neighbours(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst_id").alias("node_id"), F.col("src_id").alias("nbr_id"), "eid")


def two_hop_blocks(seeds: DataFrame, edges: DataFrame, seed: int = 0, fanout: int = 4) -> DataFrame:
    """Sampled computation blocks of the seed nodes, in long form.

    ``layer`` 2 holds the in-edges of the seeds, ``layer`` 1 those of the seeds
    and of the nodes layer 2 reaches.
    """
    seeds = materialise(seeds.select("id").distinct(), "seeds")
    outer = materialise(fanout_of(seeds, edges, 2, seed, fanout), "block2")
    frontier = materialise(seeds.union(outer.select(F.col("nbr_id").alias("id"))).distinct(), "frontier")
    inner = fanout_of(frontier, edges, 1, seed, fanout)
    columns = ["node_id", "nbr_id", "eid", "slot"]
    return (
        outer.select(F.lit(2).alias("layer"), *columns)
        .unionByName(inner.select(F.lit(1).alias("layer"), *columns))
    )


def node_index(nodes: DataFrame) -> DataFrame:
    """Dense index 0..n-1 of a sparse node set, in id order."""
    return with_position(nodes.select("id"), [F.col("id")], name="node_index")


def _draws(edges: DataFrame, k: int, n_nodes: int, seed: int) -> DataFrame:
    numbers = F.sequence(F.lit(1), F.lit(k))
    return edges.withColumn("draw", F.explode(numbers)).withColumn(
        "node_index", draw_below(n_nodes, "negative", seed, F.col("eid"), F.col("draw"))
    )


def uniform_negatives(
    edges: DataFrame, k: int, nodes: DataFrame | None = None, index: DataFrame | None = None, seed: int = 0,
    dense_count: int | None = None,
) -> DataFrame:
    """``k`` pairs (purchaser, random company) per edge; they may hit real edges.

    Drawn from ``nodes`` through a dense index, or straight from 0..dense_count-1.
    """
    if dense_count is not None:
        out = _draws(edges, k, dense_count, seed).withColumn("dst_id", F.col("node_index"))
        return out.drop("node_index")
    index = node_index(nodes) if index is None else index
    n = rows_of(index)
    drawn = _draws(edges.drop("dst_id"), k, n, seed)
    # Draws are uniform over the index: no key can be hot.
    table = index.withColumnRenamed("id", "dst_id")
    out = lookup(drawn, table, "node_index", 32, F.col("eid"), hot=NOT_HOT, rows=n)
    return out.select(*edges.columns, "draw")


def strict_negatives(
    edges: DataFrame, k: int, known: DataFrame, seed: int = 0, overdraw: int = 2, **source
) -> DataFrame:
    """``k`` pairs per edge that are no edge of ``known``.

    Draws ``overdraw * k`` per edge, removes the real ones and keeps the first
    ``k``. An edge whose purchaser buys from nearly everyone may get fewer.
    """
    drawn = uniform_negatives(edges, overdraw * k, seed=seed, **source)
    # distinct() folds parallel edges before its shuffle; the pair key of a hub
    # purchaser spreads over the drawn companies.
    real = known.select("src_id", "dst_id").distinct()
    kept = drawn.join(real, ["src_id", "dst_id"], "left_anti")
    order = Window.partitionBy("eid").orderBy("draw")  # at most overdraw * k rows
    return (
        kept.withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") <= k)
        .select(*drawn.columns)
    )


def _distinct_draws(k: int, open_ranks: Column, seed: int) -> Column:
    """``min(k, open_ranks)`` distinct numbers below ``open_ranks`` for each ``eid``, uniform, in draw order.

    The j-th draw is a rank among the numbers that earlier draws left, and becomes a number by stepping over those.
    """
    left = [draw_below(F.greatest(open_ranks - j, F.lit(1)), "open", seed, F.col("eid"), F.lit(j + 1)) for j in range(k)]
    wanted = F.slice(F.array(*left), F.lit(1), F.least(F.lit(k), open_ranks).cast("int"))

    def take(taken: Column, rank: Column) -> Column:
        # ``below`` is sorted, so each smaller number passed moves the rank up by one.
        number = F.aggregate(taken["below"], rank, lambda n, t: F.when(t <= n, n + 1).otherwise(n))
        one = F.array(number)
        return F.struct(F.array_sort(F.concat(taken["below"], one)).alias("below"), F.concat(taken["drawn"], one).alias("drawn"))

    none = F.array().cast("array<bigint>")
    return F.aggregate(wanted, F.struct(none.alias("below"), none.alias("drawn")), take, lambda taken: taken["drawn"])


def exact_negatives(
    edges: DataFrame, k: int, known: DataFrame, nodes: DataFrame | None = None, index: DataFrame | None = None,
    seed: int = 0, floor: int | None = None,
) -> DataFrame:
    """``min(k, open companies)`` distinct pairs per edge that are no edge of ``known``; nothing is drawn in vain.

    The companies a purchaser does not buy from have open ranks 0, 1, ... in index order. Each edge draws distinct open
    ranks, and an open rank becomes a company by adding the number of the purchaser's sellers that lie before it: a
    running count over its sellers and draws in one order, found by range partitions. The work is linear in
    edges * k + known; a purchaser with any number of sellers or edges is spread over tasks.
    """
    index = node_index(nodes) if index is None else index
    n = rows_of(index)
    ranks = index.select(F.col("id").alias("dst_id"), "node_index")
    sellers = known.select("src_id", "dst_id").distinct()
    sellers = lookup(sellers, ranks, "dst_id", 32, F.col("src_id"), rows=n, store=True, floor=floor)
    placed = with_position(sellers.select("src_id", "node_index"), [F.col("node_index")], ["src_id"], name="at")
    placed = materialise(placed, "sellers")
    taken = materialise(placed.groupBy("src_id").agg(F.count(F.lit(1)).alias("taken")), "taken")
    drawn = lookup(edges.drop("dst_id"), taken, "src_id", 24, F.col("eid"), "left", rows=rows_of(taken), floor=floor)
    open_ranks = F.lit(n).cast("bigint") - F.coalesce("taken", F.lit(0))
    drawn = drawn.select(*[c for c in edges.columns if c != "dst_id"], F.posexplode(_distinct_draws(k, open_ranks, seed)).alias("draw", "open"))
    drawn = drawn.withColumn("draw", F.col("draw") + 1)
    # ``open`` of a seller: the open ranks before it. Sellers go first, so a draw counts those that it has to step over.
    both = placed.select("src_id", (F.col("node_index") - F.col("at")).alias("open"), F.lit(1).alias("seller")).unionByName(
        drawn.select("src_id", "open", F.lit(0).alias("seller"), *[F.col(c) for c in drawn.columns if c not in ("src_id", "open")]),
        allowMissingColumns=True,
    )
    order = [F.col("open"), F.col("seller").desc(), F.col("eid"), F.col("draw")]
    counted = running_totals(both, {"before": "seller"}, order, ["src_id"]).filter(F.col("seller") == 0)
    counted = counted.withColumn("node_index", F.col("open") + F.col("before"))
    # Draws are uniform over the open companies: no key can be hot.
    table = index.withColumnRenamed("id", "dst_id")
    out = lookup(counted, table, "node_index", 32, F.col("eid"), hot=NOT_HOT, rows=n)
    return out.select(*edges.columns, "draw")


def labelled_examples(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Positive edges (draw 0, label 1) and their negatives (label 0) in one table."""
    pos = with_label(positives.withColumn("draw", F.lit(0)), 1)
    return pos.unionByName(with_label(negatives, 0))
