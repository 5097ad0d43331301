"""Exact maximum inner products: the best missing links under the dot score, without scoring all pairs.

Companies are ranked by the length of their vectors and cut into blocks. No company of a block scores more with a
purchaser than the product of the purchaser's length and the block's greatest (Cauchy-Schwarz), so a purchaser that has
its k best needs no block whose bound lies below the last of them; as bounds fall, it then needs none of the later ones
either. Blocks are visited in rounds of twice as many each time, and a round scores only the blocks a purchaser needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.vectors import dot_score
from supplyloom.operators.joins import lookup
from supplyloom.operators.position import with_position
from supplyloom.storage import materialise, rows_of

#: Companies of a block at least, and blocks at most (their bounds are known to every task).
BLOCK_ROWS, MAX_BLOCKS = 1024, 4096
#: Purchasers of one cell (a block with some of those that need it), and scores held at once.
CELL_ROWS, CELL_SCORES = 1 << 16, 1 << 21
#: What rounding may add to a product or take off a bound, in parts.
SLACK = 1e-9

BEST = "array<struct<neg:double,id:bigint>>"
_CANDIDATES = pa.schema(
    [("src_id", pa.int64()), ("found", pa.list_(pa.struct([("neg", pa.float64()), ("id", pa.int64())])))]
)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _block_best(k: int, width: int):
    """Rows of a cell: its companies first, then the purchasers -> each purchaser's k best companies of the block."""

    def best(scores: np.ndarray, ids: np.ndarray, barred: list[int], order: np.ndarray) -> list[dict]:
        if barred:
            # ``order`` sorts the ids, so the barred ones are found without a look at the others.
            scores[order[np.searchsorted(ids, barred, sorter=order)]] = -np.inf
        if len(scores) > k:
            near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        else:
            near = np.arange(len(scores))
        near = near[scores[near] > -np.inf]
        near = near[np.lexsort((ids[near], -scores[near]))][:k]
        return [{"neg": -float(scores[i]), "id": int(ids[i])} for i in near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, loading, ids, vectors = None, [], np.empty(0, np.int64), np.empty((0, width))
        order = np.empty(0, np.int64)
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "salt", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part, (block, salt, kind) = batch.slice(a, b - a), cells[a]
                own = part.column("id").to_numpy(zero_copy_only=False)
                x = _matrix(part.column("x"), width)
                if kind == 0:
                    if cell != (block, salt):
                        cell, loading = (block, salt), []
                    loading.append((own, x))
                    continue
                if loading:
                    ids, vectors = np.concatenate([i for i, _ in loading]), np.concatenate([v for _, v in loading])
                    order, loading = np.argsort(ids), []
                step, barred = max(1, CELL_SCORES // max(1, len(ids))), part.column("barred")
                for at in range(0, len(own), step):
                    scores = x[at : at + step] @ vectors.T
                    found = [best(s, ids, barred[at + i].as_py() or [], order) for i, s in enumerate(scores)]
                    columns = [pa.array(own[at : at + step], pa.int64()), pa.array(found, _CANDIDATES.field("found").type)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_CANDIDATES)

    return run


def _candidates(wanted: DataFrame, sellers: DataFrame, k: int, width: int, rows: int) -> DataFrame:
    """``(src_id, found)`` for each row ``(src_id, x, block, barred)`` of ``wanted``."""
    salts = max(1, -(-rows // CELL_ROWS))
    queries = wanted.select(
        "block", F.pmod(F.xxhash64("src_id"), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"), F.col("src_id").alias("id"), "x", "barred"
    )
    # A block is copied once for every CELL_ROWS purchasers.
    copies = sellers.select(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"), F.lit(0).alias("kind"), "id", "x",
        F.lit(None).cast("array<bigint>").alias("barred"),
    )
    cells = copies.unionByName(queries).repartition("block", "salt").sortWithinPartitions("block", "salt", "kind")
    return cells.mapInArrow(_block_best(k, width), f"src_id long, found {BEST}")


def topk_missing_dot(
    edges: DataFrame, embeddings: DataFrame, width: int, k: int = 5, block_rows: int = BLOCK_ROWS, floor: int | None = None
) -> DataFrame:
    """``(src_id, dst_id, place, logit)``: per purchaser the k companies of greatest ``h_u . h_v`` it does not buy from.

    Equal scores go by id. A purchaser or seller without a vector takes no part, and no company is offered to itself.
    """
    lengths = embeddings.select("id", "x", F.sqrt(dot_score(F.col("x"), F.col("x"))).alias("norm"))
    ranked = with_position(lengths, [F.col("norm").desc(), F.col("id")], name="rank")
    n = rows_of(ranked)
    size = max(block_rows, -(-n // MAX_BLOCKS))
    sellers = materialise(ranked.withColumn("block", F.expr(f"rank div {size}")).drop("rank"), "blocks")
    # At most MAX_BLOCKS rows, of falling bounds.
    bounds = [r.top for r in sellers.groupBy("block").agg(F.max("norm").alias("top")).orderBy("block").collect()]

    buyers = edges.select(F.col("src_id").alias("id")).distinct()
    none = F.array().cast(BEST)
    state = sellers.join(buyers, "id", "left_semi").select(F.col("id").alias("src_id"), "x", "norm", none.alias("best"))
    state = materialise(state, "buyers")
    pairs = edges.select("src_id", "dst_id").union(state.select("src_id", F.col("src_id").alias("dst_id"))).distinct()
    places = sellers.select(F.col("id").alias("dst_id"), "block")
    barred = lookup(pairs, places, "dst_id", 24, F.col("src_id"), rows=n, store=True, floor=floor)
    # At most a block's companies.
    barred = materialise(barred.groupBy("src_id", "block").agg(F.collect_list("dst_id").alias("barred")), "barred")

    done, low = [], 0
    while low < len(bounds):
        high = min(len(bounds), 2 * low + 1)
        here = F.lit([float(b) for b in bounds[low:high]])
        last = F.when(F.size("best") >= k, -F.element_at("best", k)["neg"])
        needed = F.filter(here, lambda b: b * F.col("norm") * F.lit(1 + SLACK) + F.abs(F.coalesce(last, F.lit(0.0))) * F.lit(SLACK) >= last)
        # Bounds fall, so the needed blocks are the first ones.
        told = state.withColumn("blocks", F.when(last.isNull(), F.lit(high - low)).otherwise(F.size(needed)))
        active = materialise(told.filter("blocks > 0"), "active")
        done.append(told.filter("blocks = 0").select("src_id", "best"))
        if not rows_of(active):
            state = None
            break
        wanted = active.select("src_id", "x", F.explode(F.sequence(F.lit(low).cast("bigint"), F.lit(low - 1) + F.col("blocks").cast("bigint"))).alias("block"))
        wanted = wanted.join(barred, ["src_id", "block"], "left")
        part = sellers.filter((F.col("block") >= low) & (F.col("block") < high))
        found = _candidates(wanted, part, k, width, rows_of(active))
        # At most k from each block of the round.
        found = found.groupBy("src_id").agg(F.flatten(F.collect_list("found")).alias("found"))
        joined = active.drop("blocks").join(found, "src_id", "left")
        best = F.slice(F.array_sort(F.concat("best", F.coalesce("found", none))), 1, k)
        state = materialise(joined.withColumn("best", best).drop("found"), "state")
        low = high
    if state is not None:
        done.append(state.select("src_id", "best"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    chosen = out.select("src_id", F.posexplode("best").alias("at", "b"))
    return chosen.select("src_id", F.col("b.id").alias("dst_id"), (F.col("at") + 1).alias("place"), (-F.col("b.neg")).alias("logit"))
