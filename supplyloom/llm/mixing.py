"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over the training time t in [0, 1], given by knots between which the weight is
linear. Its integral, scaled to the source's token target, is the source's cumulative demand. The documents of a
source lie one after the other in a fixed random order; where a document starts on that tape is the demand it meets,
and inverting the integral there gives its training position. A tape that is shorter than its target runs again.

Everything is DataFrame functions. Running sums go over buckets of the random order: sums per bucket, offsets of the
buckets, then a window in each bucket, so that a source holding most rows is spread over many tasks.

Defined cases: a null text or one without words has size 0 and is never taken (``taken`` 0, null position); a null
source is a source of its own, after all others; repeated rows each count; an empty table gives an empty result;
further columns are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.storage import materialise, rows_of

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a bucket of the random order, about.
BUCKET_ROWS = 4096
#: Weight schedules, dealt to the sources in turn like the weights: early, even and late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float, schedules: Sequence = SCHEDULES
) -> DataFrame:
    """``(source, source_size)`` -> with ``target`` and the integrated schedule ``segments``.

    A target is the source's part of ``share`` of all sizes by weight, at most ``most`` times its size; what is above
    goes to the others by weight. In the order of size over weight, the sources that stop at their limit come first,
    so the level at which the rest is shared follows from running sums. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_ratio", "turn").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    turn = F.col("turn") % F.lit(len(weights))
    ranked = (
        sizes.withColumn("turn", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("limit", F.lit(float(most)) * F.col("source_size"))
        .withColumn("limit_ratio", F.col("limit") / F.col("weight"))
        .withColumn("wanted", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("full", F.coalesce(F.sum("limit").over(by_limit), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0)))
        .withColumn("level", (F.col("wanted") - F.col("full")) / F.col("open"))
    )
    # The first source that stays under its limit sets the level; without one, all are full.
    level = F.min(F.when(F.col("level") < F.col("limit_ratio"), F.struct("limit_ratio", "turn", "level"))).over(whole)
    target = F.coalesce(F.least(F.col("limit"), F.col("weight") * level["level"]), F.col("limit"))
    shapes = F.array(*[_segments(k) for k in schedules])
    shape = F.element_at(shapes, (F.col("turn") % F.lit(len(schedules)) + 1).cast("int"))
    return ranked.select("source", "source_size", target.alias("target"), shape.alias("segments"))


def _segments(knots: Sequence[tuple[float, float]]) -> Column:
    """Pieces of a schedule: start, width, weight at the start, slope, integral up to the start, integral at the end."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if area <= 0:
        raise ValueError("a weight schedule needs a positive integral")
    pieces, done = [], 0.0
    for (t, w), (t2, w2) in zip(knots, knots[1:]):
        end = done + (t2 - t) * (w + w2) / 2 / area
        piece = {"t": t, "d": t2 - t, "w": w / area, "s": (w2 - w) / area / (t2 - t), "a": done, "b": end}
        pieces.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in piece.items()]))
        done = end
    return F.array(*pieces)


def position_of(segments: Column, demand: Column) -> Column:
    """The time at which the integral of the schedule reaches ``demand`` (0 to 1)."""
    inside = F.filter(segments, lambda x: x["b"] > demand)
    piece = F.when(F.size(inside) > 0, inside[0]).otherwise(F.element_at(segments, -1))
    missing = F.greatest(demand - piece["a"], F.lit(0.0))
    # w x + s x^2 / 2 = missing, in the form that holds for s = 0 too
    root = F.sqrt(F.greatest(piece["w"] * piece["w"] + 2 * piece["s"] * missing, F.lit(0.0)))
    x = F.when(missing > 0, 2 * missing / (piece["w"] + root)).otherwise(0.0)
    return piece["t"] + F.least(x, piece["d"])


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    schedules: Sequence = SCHEDULES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken, copies, tape, segments`` and the ``keep`` columns.

    A document is taken as often as the middle of its place on the repeated tape lies before its source's target, so
    the words taken miss the target by half a document at most, and with ``most`` = 2 nothing is taken three times.
    """
    # The random order is that of a digest of the id, or of the text where there is no id.
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    draw = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    named = ["doc_id", "source", size.alias("size"), draw.alias("draw"), F.xxhash64("text").alias("tie")]
    sizes = materialise(docs.select(*named), "mix-sizes")
    bits = max(0, math.ceil(math.log2(max(1, rows_of(sizes)) / BUCKET_ROWS)))
    bucket = F.shiftright("draw", 60 - bits)
    # Texts and other wide columns to keep are not written a second time; their rows are counted again instead.
    more = [c for c in keep if c not in ("doc_id", "source")]
    sized = (docs.select(*named, *more) if more else sizes).withColumn("bucket", bucket)

    buckets = sizes.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most, schedules
    )
    offsets = (
        buckets.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
        .alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select("b.source", "b.bucket", "offset", "source_size", "target", "segments")
    )
    order = Window.partitionBy("source", "bucket").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size", "tie")
    placed = (
        sized.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .alias("d")
        .join(
            offsets.alias("o"),
            F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket")),
        )
        .withColumn("tape", F.col("offset") + F.col("within"))
    )
    middle = F.col("tape") + F.col("size") / 2
    times = F.ceil((F.col("target") - middle) / F.col("source_size")).cast("int")
    copies = F.when((F.col("size") > 0) & (middle < F.col("target")), F.greatest(times, F.lit(1))).otherwise(0)
    columns = [F.col(f"d.{c}") for c in dict.fromkeys(["doc_id", "size", *keep])]
    return placed.withColumn("copies", copies).select(
        *columns, "source_size", "target", (F.col("d.size") * F.col("copies")).alias("taken"), "copies", "tape", "segments"
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy with its ``epoch`` and ``position``, range-sorted by position."""
    copies = mixed.where(F.col("copies") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    demand = (F.col("epoch") * F.col("source_size") + F.col("tape")) / F.col("target")
    at = copies.withColumn("position", position_of(F.col("segments"), demand)).drop("segments", "copies")
    return at.repartitionByRange(F.col("position")).sortWithinPartitions("position", "doc_id", "epoch")


def digest_mix(mixed: DataFrame, copies: DataFrame) -> DataFrame:
    """Per document the words that ``copies`` (of ``training_order``) hold of it, and the position of the first.

    Both need ``source``. A document that is taken has words, so its place on its source's tape is its own, whatever
    its id; documents without copies follow from ``mixed``.
    """
    named = ["doc_id", "size", "source_size", "target"]
    taken = copies.groupBy("source", "tape").agg(
        *[F.first(c).alias(c) for c in named], F.sum("size").alias("taken"), F.min("position").alias("position")
    )
    left = mixed.where(F.col("copies") == 0).select(*named, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("double").alias("position"))
    return taken.select(*named, "taken", "position").unionByName(left)
