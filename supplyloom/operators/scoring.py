"""Scores of relations: known ones, rejected ones and missing ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.activations import sigmoid
from supplyloom.functions.vectors import dot_score
from supplyloom.operators.joins import NOT_HOT, fits_broadcast, hot_keys, lookup
from supplyloom.operators.position import with_position
from supplyloom.operators.refine import MIN_CONFIDENCE
from supplyloom.sources.schemas import EDGES, require
from supplyloom.storage import rows_of


def _salt(relations: DataFrame, other: str) -> Column:
    return F.col("eid") if "eid" in relations.columns else F.col(other)


def with_logit(relations: DataFrame, ends: DataFrame, bias: float, how: str = "left", floor: int | None = None) -> DataFrame:
    """Adds ``logit`` from the written table of endpoint scores.

    ``left`` keeps relations with an unknown company, with a null logit.
    """
    require(relations, EDGES, "relation table")
    out = relations
    # One pass finds the hot ids of both ends, and only when a shuffle is needed at all.
    rows = rows_of(ends)
    hot = {} if fits_broadcast(rows, 24) else hot_keys(relations, "src_id", "dst_id", floor=floor)
    for key, column, other in (("src_id", "as_buyer", "dst_id"), ("dst_id", "as_seller", "src_id")):
        table = ends.select(F.col("id").alias(key), column)
        out = lookup(out, table, key, 24, _salt(relations, other), how, hot.get(key, NOT_HOT), rows=rows)
    logit = (F.col("as_buyer") + F.col("as_seller") + F.lit(float(bias))).alias("logit")
    return out.select(*relations.columns, logit)


def score_relations(relations: DataFrame, ends: DataFrame, bias: float, floor: int | None = None) -> DataFrame:
    """Adds ``gnn_prediction`` in (0, 1); null where a company is unknown."""
    scored = with_logit(relations, ends, bias, "left", floor)
    return scored.withColumn("gnn_prediction", sigmoid(F.col("logit"))).drop("logit")


def dot_scores(pairs: DataFrame, embeddings: DataFrame, width: int, floor: int | None = None) -> DataFrame:
    """Adds ``logit`` = ``h_u . h_v`` per distinct pair ``(src_id, dst_id)``.

    Vectors are heavy, so score distinct pairs and join the result back.
    """
    out, rows, row_bytes = pairs, rows_of(embeddings), 8 * width + 32
    hot = {} if fits_broadcast(rows, row_bytes) else hot_keys(pairs, "src_id", "dst_id", floor=floor)
    for key, column, other in (("src_id", "hu", "dst_id"), ("dst_id", "hv", "src_id")):
        table = embeddings.select(F.col("id").alias(key), F.col("x").alias(column))
        out = lookup(out, table, key, row_bytes, F.col(other), "left", hot.get(key, NOT_HOT), rows=rows)
    return out.withColumn("logit", dot_score(F.col("hu"), F.col("hv"))).drop("hu", "hv")


def rejected_links(
    bronze: DataFrame, ends: DataFrame, bias: float, threshold: float = MIN_CONFIDENCE
) -> DataFrame:
    """Links dropped for low or missing confidence, scored again.

    ``admitted`` marks those the model puts at or above the threshold.
    """
    dropped = bronze.filter(F.col("probability").isNull() | (F.col("probability") < F.lit(threshold)))
    scored = score_relations(dropped, ends, bias)
    return scored.withColumn(
        "admitted", F.coalesce(F.col("gnn_prediction") >= F.lit(threshold), F.lit(False))
    )


def topk_missing_links(edges: DataFrame, ends: DataFrame, bias: float, k: int = 5) -> DataFrame:
    """The ``k`` best-scored companies each purchaser does not buy from yet.

    With a linear score all purchasers rank sellers alike. So sellers get one
    global rank, and a purchaser's answer is the first ``k`` ranks its own
    sellers (and itself) leave open. The work is linear in edges + k * companies;
    no pair of companies without an edge is ever formed except the results.
    """
    ranks = with_position(
        ends.select("id", "as_seller"), [F.col("as_seller").desc(), F.col("id")], name="rank"
    )
    n = rows_of(ranks)
    # The purchaser's own rank is taken too: no company is offered to itself.
    buyers = edges.select("src_id").distinct()
    taken = edges.select("src_id", "dst_id").union(buyers.select("src_id", F.col("src_id").alias("dst_id"))).distinct()
    places = ranks.select(F.col("id").alias("dst_id"), "rank")
    taken = lookup(taken, places, "dst_id", 24, F.col("src_id"), rows=n, store=True)
    placed = with_position(taken.select("src_id", "rank"), [F.col("rank")], ["src_id"], name="at")
    # rank - at = how many open ranks lie before this taken one; it never falls.
    open_before = (F.col("rank") - F.col("at")).alias("open_before")
    steps = (
        placed.select("src_id", open_before)
        .filter(F.col("open_before") < k)
        .groupBy("src_id", "open_before")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most k rows per purchaser from here on.
    below = steps.groupBy("src_id").agg(
        *[F.sum(F.when(F.col("open_before") <= t, F.col("n")).otherwise(0)).alias(f"c{t}") for t in range(k)]
    )
    per_buyer = buyers.join(below, "src_id", "left")
    picks = F.array(
        *[F.struct(F.lit(t + 1).alias("place"), (F.lit(t) + F.coalesce(F.col(f"c{t}"), F.lit(0))).alias("rank")) for t in range(k)]
    )
    chosen = per_buyer.select("src_id", F.explode(picks).alias("p")).select("src_id", "p.place", "p.rank")
    chosen = chosen.filter(F.col("rank") < n)
    # The first ranks are wanted by nearly every purchaser: lookup salts them.
    chosen = lookup(chosen, ranks, "rank", 32, F.col("src_id"), rows=n, store=True)
    buyer_half = ends.select(F.col("id").alias("src_id"), "as_buyer")
    chosen = lookup(chosen, buyer_half, "src_id", 24, F.col("place"), hot=NOT_HOT, rows=n)
    logit = F.col("as_buyer") + F.col("as_seller") + F.lit(float(bias))
    return chosen.select("src_id", F.col("id").alias("dst_id"), "place", sigmoid(logit).alias("gnn_prediction"))
