"""Exact positions and running totals over a whole table.

A window without ``partitionBy`` sorts the table in one task, and one that
partitions by a hot segment sorts a third of it in one task. Here the rows are
range-partitioned by the full order key (so a hot segment spreads over many
partitions), each partition numbers its own rows, and only the per-partition
counts are combined. The sorted rows are written once: range bounds come from a
sample and may differ if they were computed a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.operators.joins import fits_broadcast
from supplyloom.storage import materialise, rows_of, with_known_rows

_SLOT, _PART, _FIRST = "__slot", "__part", "__first"
OFFSET_BYTES = 96
_PART_BITS = 33  # monotonically_increasing_id: partition above, row below


def _ranged(df: DataFrame, keys: list[Column], label: str) -> DataFrame:
    slots = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        _SLOT, F.monotonically_increasing_id()
    )
    table = materialise(slots, label)
    return with_known_rows(table.withColumn(_PART, F.shiftright(_SLOT, _PART_BITS)), rows_of(table))


def _join_offsets(rows: DataFrame, offsets: DataFrame, segment_by: list[str]) -> DataFrame:
    """Few segments: no shuffle. Many: a key holds at most one range partition of rows."""
    offsets = materialise(offsets, "offsets")
    small = fits_broadcast(rows_of(offsets), OFFSET_BYTES)
    return rows.join(F.broadcast(offsets) if small else offsets, [*segment_by, _PART])


def with_position(
    df: DataFrame,
    order_by: list[Column],
    segment_by: list[str] = (),
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Adds the 0-based position in ``order_by`` order, per segment if given.

    ``order_by`` must be a total order. ``total`` names an optional column with
    the number of rows of the segment. Segment columns must not be null.
    """
    segment_by = list(segment_by)
    rows = _ranged(df, [*[F.col(c) for c in segment_by], *order_by], "position")
    pieces = rows.groupBy(*segment_by, _PART).agg(
        F.count(F.lit(1)).alias("__n"), F.min(_SLOT).alias(_FIRST)
    )
    if segment_by:
        # One row per (segment, partition): at most partitions rows per segment.
        before = Window.partitionBy(*segment_by).orderBy(_PART)
        offsets = pieces.select(
            *segment_by,
            _PART,
            (F.sum("__n").over(before) - F.col("__n") - F.col(_FIRST)).alias("__shift"),
            F.sum("__n").over(Window.partitionBy(*segment_by)).alias("__total"),
        )
        joined = _join_offsets(rows, offsets, segment_by)
    else:
        # One row per partition, so the running sum is the driver's to do.
        counts = sorted(pieces.collect(), key=lambda r: r[_PART])
        shifts, seen = [], 0
        for r in counts:
            shifts.append((r[_PART], seen - r[_FIRST]))
            seen += r["__n"]
        offsets = df.sparkSession.createDataFrame(shifts, f"{_PART} long, __shift long").withColumn(
            "__total", F.lit(seen).cast("bigint")
        )
        joined = rows.withColumn(_PART, F.col(_PART).cast("bigint")).join(F.broadcast(offsets), _PART)
    extra = [F.col("__total").alias(total)] if total else []
    out = joined.select(*df.columns, (F.col(_SLOT) + F.col("__shift")).alias(name), *extra)
    return with_known_rows(out, rows_of(rows))


def running_totals(
    df: DataFrame, sums: dict[str, str], order_by: list[Column], segment_by: list[str] = ()
) -> DataFrame:
    """Adds ``sums`` = {new column: summed column}, inclusive, in ``order_by`` order."""
    segment_by = list(segment_by)
    rows = _ranged(df, [*[F.col(c) for c in segment_by], *order_by], "running")
    pieces = rows.groupBy(*segment_by, _PART).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = Window.partitionBy(*segment_by).orderBy(_PART) if segment_by else None
    if before is not None:
        offsets = pieces.select(
            *segment_by, _PART, *[(F.sum(f"__{n}").over(before) - F.col(f"__{n}")).alias(f"__{n}") for n in sums]
        )
        joined = _join_offsets(rows, offsets, segment_by)
    else:
        seen = {n: 0 for n in sums}
        shifts = []
        for r in sorted(pieces.collect(), key=lambda r: r[_PART]):
            shifts.append((int(r[_PART]), *[seen[n] for n in sums]))
            for n in sums:
                seen[n] += r[f"__{n}"] or 0
        fields = ", ".join(f"__{n} {df.schema[c].dataType.simpleString()}" for n, c in sums.items())
        offsets = df.sparkSession.createDataFrame(shifts, f"{_PART} bigint, {fields}")
        joined = rows.withColumn(_PART, F.col(_PART).cast("bigint")).join(F.broadcast(offsets), _PART)
    # Within one range partition: bounded by the partition size, never by the segment.
    here = Window.partitionBy(*segment_by, _PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns, *[(F.sum(c).over(here) + F.col(f"__{n}")).alias(n) for n, c in sums.items()]
    )


BINS = 4096


def values_at(df: DataFrame, key: str, ranks: list[int]) -> dict[int, tuple[int, int]]:
    """For each 0-based rank the value of the whole-number column ``key`` there, and how many rows lie below it.

    Found by counting: each pass splits the ranges that hold a rank into BINS equal parts, so the rows are scanned a
    few times (twice for dense numbers) and never shuffled or sorted; only counts per part leave a task.
    """
    keys = df.select(F.col(key).cast("decimal(20,0)").alias("k")).filter(F.col("k").isNotNull())
    ends = keys.agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n")).first()
    ranks = sorted({r for r in ranks if 0 <= r < (ends.n or 0)})
    if not ranks:
        return {}
    found: dict[int, tuple[int, int]] = {}
    spans = {(int(ends.low), int(ends.high) + 1, 0): ranks}  # (low, end, rows below) -> ranks inside
    while spans:
        narrower: dict[tuple[int, int, int], list[int]] = {}
        for (low, end, below), wanted in spans.items():
            width = -(-(end - low) // BINS)
            part = F.expr(f"cast((k - {low}BD) div {width}BD as int)")
            counts = keys.filter(f"k >= {low}BD AND k < {end}BD").groupBy(part.alias("p")).count()
            for row in sorted(counts.collect(), key=lambda r: r.p):  # at most BINS rows
                inside = [r for r in wanted if below <= r < below + row["count"]]
                start = low + row.p * width
                if inside and width == 1:
                    found |= {r: (start, below) for r in inside}
                elif inside:
                    narrower[(start, min(start + width, end), below)] = inside
                below += row["count"]
        spans = narrower
    return found
